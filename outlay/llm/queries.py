"""The registered queries ``opN_<name>`` and ``pipeline``, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from outlay.llm import language_ecoc, personal_data, quality_crf, toxicity_gru
from outlay.llm.byte_bpe_frames import encode_digests
from outlay.llm.collocations import collocations
from outlay.llm.common import read_table
from outlay.llm.decontamination import contaminated_documents
from outlay.llm.exact_dedup import exact_duplicates
from outlay.llm.minhash_dedup import near_duplicates
from outlay.llm.sentence_pieces import encode_piece_digests
from outlay.llm.spelling_variants import spelling_variants
from outlay.llm.suffix_dedup import removal_digests
from outlay.llm.token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_ecoc.identify(docs, language_ecoc.train(docs))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return personal_data.personal_data(docs, personal_data.train(docs))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(read_table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(read_table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_crf.quality_scores(docs, quality_crf.train(docs, read_table(spark, sf_dir, "labels")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity_gru.toxicity_scores(docs, toxicity_gru.train(docs, read_table(spark, sf_dir, "labels")))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_piece_digests(read_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_personal_data": op2_personal_data,
    "op3_decontamination": op3_decontamination,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality": op7_quality,
    "op8_toxicity": op8_toxicity,
    "op9_token_counts": op9_token_counts,
    "op10_minhash": op10_minhash,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_sentence_pieces": op12_sentence_pieces,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {
    "op4_exact_dedup": r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM texts
""",
    "op11_spelling_variants": r"""
WITH RECURSIVE steps AS (
  SELECT list(v ORDER BY i) AS steps FROM (
    SELECT i, list_reduce([CAST(i AS UBIGINT)] || CAST(range(8) AS UBIGINT[]),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) AS v
    FROM range(256) AS r(i)
  )
),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS doc, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
),
hashed AS (
  SELECT run, xor(CAST(4294967295 AS UBIGINT), list_reduce(
    [CAST(4294967295 AS UBIGINT)] || CAST(flatten(list_transform(string_split(doc || run, ''),
      lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)] ELSE [195, unicode(ch) - 64] END)) AS UBIGINT[]),
    lambda c, b: xor(c >> 8, steps[CAST(xor(c, b) & 255 AS BIGINT) + 1]))) AS h
  FROM runs, steps WHERE length(run) >= 6
),
noisy AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word
  FROM hashed
),
words AS (SELECT word, count(*) AS n FROM noisy WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
places AS (SELECT word, n, unnest(range(CAST(length(word) AS INT))) AS i FROM words),
lost AS (SELECT word, n, i, left(word, CAST(i AS INT)) || substr(word, CAST(i AS INT) + 2) AS rest FROM places),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM lost AS a JOIN lost AS b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM lost AS a JOIN words AS b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM lost AS a JOIN words AS b ON a.rest = b.word
),
best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, other_n FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1
),
found AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.other_n >= 5 * w.n THEN b.other END AS form, CASE WHEN b.other_n >= 5 * w.n THEN b.other_n END AS form_n
  FROM words AS w LEFT JOIN best AS b ON b.word = w.word
),
ways AS (
  SELECT word, word AS root FROM found
  UNION ALL SELECT p.word, f.form FROM ways AS p JOIN found AS f ON f.word = p.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, p.root
FROM found AS f JOIN ways AS p ON p.word = f.word JOIN found AS e ON e.word = p.root AND e.form IS NULL
""",
    "op13_collocations": r"""
WITH lowered AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
),
cut AS (SELECT d, lang, string_split_regex(t, '[.,;:!?\x0A-\x0D]') AS ps FROM lowered),
pieces AS (SELECT d, lang, unnest(range(len(ps))) AS i, unnest(ps) AS piece FROM cut),
split AS (SELECT d, lang, i, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
words AS (SELECT d, lang, i, unnest(range(len(ws))) AS j, unnest(ws) AS w FROM split),
runs AS (
  SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4, lead(w, 4) OVER o AS w5
  FROM words WINDOW o AS (PARTITION BY d, i ORDER BY j)
),
grams AS (
  SELECT lang, [w1] AS ws FROM runs
  UNION ALL SELECT lang, [w1, w2] FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, [w1, w2, w3] FROM runs WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, [w1, w2, w3, w4] FROM runs WHERE w4 IS NOT NULL
  UNION ALL SELECT lang, [w1, w2, w3, w4, w5] FROM runs WHERE w5 IS NOT NULL
),
f AS (SELECT lang, ws, len(ws) AS m, count(*) AS f FROM grams GROUP BY lang, ws HAVING count(*) >= 100),
sums AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
reached AS (
  SELECT lang, ws, max(f) AS most FROM (
    SELECT lang, ws[1:m - 1] AS ws, f FROM f WHERE m > 2
    UNION ALL SELECT lang, ws[2:m] AS ws, f FROM f WHERE m > 2
  ) GROUP BY lang, ws
),
candidates AS (
  SELECT c.lang, c.ws, c.m, c.f AS a FROM f AS c LEFT JOIN reached AS x ON x.lang = c.lang AND x.ws = c.ws
  WHERE c.m > 1 AND (x.most IS NULL OR x.most < c.f)
),
cuts AS (SELECT lang, ws, m, a, unnest(range(1, m)) AS k FROM candidates),
scored AS (
  SELECT c.lang, array_to_string(c.ws, ' ') AS phrase, c.a, c.k, l.f AS l, r.f AS r, s.n,
         CAST((CAST(1000 AS HUGEINT) * c.a * s.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts AS c
  JOIN f AS l ON l.lang = c.lang AND l.ws = c.ws[1:c.k]
  JOIN f AS r ON r.lang = c.lang AND r.ws = c.ws[c.k + 1:c.m]
  JOIN sums AS s ON s.lang = c.lang
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
""",
}
