"""Personal data: generators propose spans, boosted trees score them, calibrated thresholds select.

Base spans of four kinds are found by fixed patterns and checks and always
count. Wider patterns propose more candidates, overlapping ones too. Trees are
boosted on format and context features of all candidates of all documents;
base spans are the positive cases, the other candidates the negative ones.
Per kind the lowest score counts from which on at least ``PRECISION`` of a
second half of the documents' candidates are base spans. A candidate above it
that touches no base span is added.

Everything is column expressions: patterns, positions, features and trees. The
base patterns are written so that a match never has to be sought twice in the
same characters (possessive repeats and look-behind), which changes no match.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.llm.boosted_trees import Boosted, boost, calibrated_threshold
from outlay.llm.common import doc_bucket, id_and_text

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
_WORD = "A-Za-z0-9._%+-"
#: Same matches as the contract's patterns; a card's 14 to 19 digits are counted in the pattern.
BASE_PATTERNS = {
    "email": rf"(?:\G|(?<![{_WORD}]))[{_WORD}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Candidate patterns: masked addresses, other separators, other lengths.
WIDE_PATTERNS = {
    "email": r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]|\{at\}) ?[\p{L}0-9-]{1,63}+(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[\p{L}0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:[.,:][0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])(?<![0-9][ .-])[0-9](?:[ .-]?[0-9]){12,18}+(?![ .-]?[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+|00)?\(?[0-9](?:[ ().\-/]{0,2}[0-9]){6,14}+(?![0-9A-Za-z])",
}
#: Words before a span that tell of personal data, as fixed values.
TELLING = r"(?i)(?:mail|e-mail|call|phone|tel|mobile|fax|card|visa|address|contact|host|ip)[ .:=]*$"
FEATURES = ("digits", "separators", "groups", "plus", "valid", "letters", "before", "after", "telling")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits' weighted sum ends in 0; every second digit from the right counts double."""
    signs = F.reverse(F.split(digits, ""))
    weighted = F.transform(
        F.filter(signs, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(weighted, F.lit(0), lambda total, d: total + d) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    """The check of one kind on a matched text."""
    count = F.length(_digits(match))
    if kind == "email":
        return match.contains("@") & match.rlike(r"\.[A-Za-z]{2,}$")
    if kind == "ip":
        parts = F.transform(F.split(match, "[.,:]"), lambda part: F.regexp_replace(part, "^0+", ""))
        small = lambda part: (F.length(part) < 3) | ((F.length(part) == 3) & (part <= "255"))
        return F.forall(parts, small)
    if kind == "card":
        return count.between(14, 19) & _luhn(_digits(match))
    return count.between(10, 15)


def _counts_as_base(kind: str, span: Column) -> Column:
    """Whether a match of the base pattern passes the kind's check; an address has none."""
    return F.lit(True) if kind == "email" else _valid(kind, span["match"])


_SPAN = "array<struct<start:int,end:int,match:string,before:string,after:string>>"
#: Matches that are placed one after the other; groups of them are placed by their lengths.
_GROUP = 256


def _items(text: Column, matches: Column, pattern: str) -> Column:
    """Every match with the gaps around it: what a split by the same pattern leaves."""
    gaps = F.split(text, pattern, -1)
    return F.arrays_zip(
        F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("match"), F.slice(gaps, 2, F.size(matches)).alias("next")
    )


def _grouped(items: Column) -> Column:
    """Groups of matches: their length together, and each one's place from the group's begin.

    Growing an array copies it, so a text with very many matches needs short ones.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))

    def add(state: Column, item: Column) -> Column:
        begin = state["at"] + F.length(item["gap"])
        end = begin + F.length(item["match"])
        span = F.struct(
            begin.alias("start"),
            end.alias("end"),
            item["match"].alias("match"),
            F.right(item["gap"], F.lit(16)).alias("before"),
            F.left(item["next"], F.lit(1)).alias("after"),
        )
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(span)).alias("found"))

    numbers = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _GROUP).cast("int"))
    groups = F.transform(numbers, lambda g: F.aggregate(F.slice(items, g * _GROUP + 1, F.lit(_GROUP)), start, add))
    return F.when(F.size(items) > 0, groups).otherwise(F.array().cast(f"array<struct<at:int,found:{_SPAN}>>"))


def _placed(groups: Column) -> Column:
    """start, end (code points), the match and what stands around it, for every match."""
    begins = F.aggregate(
        groups, F.array(F.lit(0)), lambda so_far, group: F.concat(so_far, F.array(F.element_at(so_far, -1) + group["at"]))
    )

    def moved(group: Column, begin: Column) -> Column:
        return F.transform(
            group["found"],
            lambda span: F.struct(
                (span["start"] + begin).alias("start"),
                (span["end"] + begin).alias("end"),
                *[span[name].alias(name) for name in ("match", "before", "after")],
            ),
        )

    return F.flatten(F.zip_with(groups, F.slice(begins, F.lit(1), F.size(groups)), moved))


def _char_class(sign: Column) -> Column:
    """0: white space or nothing, 1: letter, 2: digit, 3: quote or equals sign, 4: other."""
    return (
        F.when((F.length(sign) == 0) | sign.rlike(r"^\s$"), 0)
        .when(sign.rlike(r"^\p{L}$"), 1)
        .when(sign.rlike("^[0-9]$"), 2)
        .when(sign.isin("=", '"', "'", ":"), 3)
        .otherwise(4)
    )


def _described(kind: str, span: Column) -> Column:
    """The span with its features, all small integers."""
    match = span["match"]
    features = {
        "digits": F.least(F.length(_digits(match)), F.lit(20)),
        "separators": F.least(F.length(F.regexp_replace(match, r"[\p{L}0-9]", "")), F.lit(8)),
        "groups": F.least(F.size(F.split(match, "[^0-9]+")), F.lit(6)),
        "plus": match.startswith("+").cast("int"),
        "valid": _valid(kind, match).cast("int"),
        "letters": match.rlike(r"\p{L}").cast("int"),
        "before": _char_class(F.right(span["before"], F.lit(1))),
        "after": _char_class(span["after"]),
        "telling": span["before"].rlike(TELLING).cast("int"),
    }
    return F.struct(span["start"].alias("start"), span["end"].alias("end"), *[features[f].cast("int").alias(f) for f in FEATURES])


def _candidates(docs: DataFrame) -> DataFrame:
    """doc_id, bucket, and per kind the base spans (``b_``) and the described wide candidates (``w_``)."""
    rows = id_and_text(docs)
    # A pattern can only match where its signs are.
    likely = {
        "email": F.col("text").contains("@") | F.col("text").rlike(r"[(\[{]at[)\]}]"),
        **dict.fromkeys(("ip", "card", "phone"), F.col("text").rlike("[0-9]")),
    }
    none = F.array().cast("array<string>")
    found = [
        F.when(likely[k], F.regexp_extract_all("text", F.lit(patterns[k]), F.lit(0))).otherwise(none).alias(f"{sign}_{k}")
        for sign, patterns in (("b", BASE_PATTERNS), ("w", WIDE_PATTERNS))
        for k in KINDS
    ]
    rows = rows.select("doc_id", "text", *found)
    items = [
        _items(F.col("text"), F.col(f"{sign}_{k}"), patterns[k]).alias(f"{sign}_{k}")
        for sign, patterns in (("b", BASE_PATTERNS), ("w", WIDE_PATTERNS))
        for k in KINDS
    ]
    rows = rows.select("doc_id", *items)
    # Each step names the one before it more than once, so Spark does not write them into one another.
    for step in (_grouped, _placed):
        rows = rows.select("doc_id", *[step(F.col(f"{sign}_{k}")).alias(f"{sign}_{k}") for sign in "bw" for k in KINDS])
    checked = []
    for k in KINDS:
        checked.append(F.filter(f"b_{k}", partial(_counts_as_base, k)).alias(f"b_{k}"))
        checked.append(F.transform(f"w_{k}", partial(_described, k)).alias(f"w_{k}"))
    return rows.select("doc_id", doc_bucket(F.col("doc_id"), 2).alias("bucket"), *checked)


@dataclass(frozen=True)
class SpanModel:
    trees: dict[str, Boosted]
    thresholds: dict[str, float]


def _case(kind: str, candidate: Column) -> Column:
    """A candidate's features and whether it is a base span."""
    is_base = F.exists(
        f"b_{kind}", lambda b: (b["start"] == candidate["start"]) & (b["end"] == candidate["end"])
    )
    return F.struct(F.lit(kind).alias("kind"), *[candidate[f].alias(f) for f in FEATURES], is_base.alias("is_base"))


def _numbered(number: int, span: Column) -> Column:
    return F.struct(span["start"].alias("start"), F.lit(number).alias("kind"), span["end"].alias("end"))


def _as_number(span: Column) -> Column:
    """A span as one number; texts have fewer than 2^30 characters."""
    return span["start"].cast("long") * 2**32 + span["end"].cast("long") * 4 + span["kind"].cast("long")


def _from_number(number: Column) -> Column:
    end = F.floor((number % 2**32) / 4)
    return F.struct(
        F.shiftright(number, 32).cast("int").alias("start"), (number % 4).cast("int").alias("kind"), end.cast("int").alias("end")
    )


def _above(trees: Boosted, threshold: float, candidate: Column) -> Column:
    return trees.column(lambda f: candidate[FEATURES[f]]) >= threshold


def train(docs: DataFrame) -> SpanModel:
    """Boost and calibrate on counts of feature combinations over all documents.

    The counts' number is bounded by the features' ranges; only they come to
    the driver. Trees learn from one half of the documents, thresholds from
    the other.
    """
    found = _candidates(docs)
    cases = F.concat(*[F.transform(f"w_{k}", partial(_case, k)) for k in KINDS])
    rows = found.select("bucket", F.explode(cases).alias("c")).select("bucket", "c.*")
    counted = rows.groupBy("bucket", "kind", *FEATURES).agg(
        F.count(F.when(F.col("is_base"), 1)).alias("positive"), F.count(F.when(~F.col("is_base"), 1)).alias("negative")
    )
    table = counted.orderBy("bucket", "kind", *FEATURES).toPandas()
    trees, thresholds = {}, {}
    for k in KINDS:
        parts = []
        for bucket in (0, 1):
            part = table[(table["kind"] == k) & (table["bucket"] == bucket)]
            parts.append([part[list(FEATURES)].to_numpy(dtype=np.int64), part["positive"].to_numpy(float), part["negative"].to_numpy(float)])
        trees[k] = boost(*parts[0])
        thresholds[k] = calibrated_threshold(trees[k].log_odds(parts[1][0]), *parts[1][1:], PRECISION)
    return SpanModel(trees, thresholds)


def _spans(docs: DataFrame, model: SpanModel) -> DataFrame:
    """doc_id, and arrays of ``start, kind (its number), end``: ``base`` and ``spans`` (base and added), sorted."""
    rows = _candidates(docs)
    counts = [F.size(f"b_{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    base = F.concat(*[F.transform(f"b_{k}", partial(_numbered, n)) for n, k in enumerate(KINDS)])
    chosen = []
    for n, k in enumerate(KINDS):
        if np.isfinite(model.thresholds[k]):
            above = F.filter(f"w_{k}", partial(_above, model.trees[k], model.thresholds[k]))
            chosen.append(F.transform(above, partial(_numbered, n)))
    kind = "array<struct<start:int,kind:int,end:int>>"
    added = F.concat(*chosen) if chosen else F.array().cast(kind)
    rows = rows.select("doc_id", *counts, F.array_sort(base.cast(kind)).alias("base"), added.cast(kind).alias("added"))
    # Most candidates that are chosen are base spans themselves. As numbers they leave by hash, not one against all.
    others = F.array_except(F.transform("added", _as_number), F.transform("base", _as_number))
    rows = rows.withColumn("added", F.transform(others, _from_number).cast(kind))
    apart = F.filter(
        "added", lambda a: ~F.exists("base", lambda b: (a["start"] < b["end"]) & (b["start"] < a["end"]))
    )
    # Of added spans that overlap, the first in order stays.
    clear = F.filter(
        F.array_sort(apart),
        lambda a, i: ~F.exists(
            F.slice(F.array_sort(apart), F.lit(1), i), lambda b: (a["start"] < b["end"]) & (b["start"] < a["end"])
        ),
    )
    return rows.select("doc_id", *[f"n_{k}" for k in KINDS], "base", F.array_sort(F.concat("base", clear)).alias("spans"))


def _as_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def personal_data(docs: DataFrame, model: SpanModel) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Null text counts as empty. Spans of two kinds may overlap; an added span
    overlaps neither a base span nor another added one that begins before it.
    An empty table gives no rows.
    """
    return _spans(docs, model).select(
        "doc_id",
        *[f"n_{k}" for k in KINDS],
        F.sha2(_as_text(F.col("base")), 256).alias("base_sha256"),
        _as_text(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )
