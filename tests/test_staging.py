import datetime
from decimal import Decimal

import pytest
from fixtures import AS_OF, AGENCY, PLACE, agreement, amendment, documents, lines, raw_agreements
from pyspark.sql import functions as F

from outlay.operators.versions import latest_version, representative
from outlay.plans import dimensions, facts, staging
from outlay.schemas import AGREEMENT_FIELDS, AMENDMENT_FIELDS, document_schema
from outlay.sources.landing import read_jsonl

FIRST, SECOND = "2026-07-01 06:00:00", "2026-07-02 06:00:00"


def staged(spark, loads):
    return staging.stg_convenios(raw_agreements(spark, loads), AS_OF)


def ids(frame):
    return sorted(row["id_convenio"] for row in frame.collect())


def test_columns_and_types(spark):
    frame = staged(spark, {FIRST: [agreement(1)]})
    assert frame.columns == [name for _, name, _ in AGREEMENT_FIELDS] + ["carregado_em"]
    row = frame.collect()[0]
    assert row["valor"] == Decimal("100.00") and row["data_publicacao"] == datetime.date(2026, 3, 10)
    assert row["municipio_uf_sigla"] == "MS" and row["orgao_superior_codigo"] == "36000"
    assert dict(frame.dtypes)["valor"] == "decimal(18,2)"


def test_newest_version_wins(spark):
    frame = staged(spark, {FIRST: [agreement(1)], SECOND: [agreement(1, valor=150.0)]})
    assert [row["valor"] for row in frame.collect()] == [Decimal("150.00")]


def test_tie_on_load_time_is_stable(spark):
    loads = {FIRST: [agreement(2, valor=10.0), agreement(2, valor=20.0)]}
    raw = raw_agreements(spark, loads)
    found = {
        tuple(row["valor"] for row in staging.stg_convenios(raw.repartition(n), AS_OF).collect()) for n in (1, 3, 7)
    }
    assert len(found) == 1 and len(found.pop()) == 1


def test_version_is_chosen_before_the_filters(spark):
    incomplete = agreement(3, municipioConvenente={**PLACE, "codigoIBGE": None})
    assert ids(staged(spark, {FIRST: [agreement(3)], SECOND: [incomplete]})) == []
    assert ids(staged(spark, {FIRST: [incomplete], SECOND: [agreement(3)]})) == [3]


def test_incomplete_and_old_rows_drop(spark):
    rows = [
        agreement(4, orgao={**AGENCY, "orgaoMaximo": None}),
        agreement(5, dataPublicacao="1996-05-01"),
        agreement(6, dataPublicacao="2023-07-20"),
        agreement(7, dataPublicacao="2023-07-19"),
        agreement(8, dataPublicacao=None),
    ]
    assert ids(staged(spark, {FIRST: rows})) == [6]


def test_leading_zero_code_stays_text(spark):
    frame = staged(spark, {FIRST: [agreement(1, municipioConvenente={**PLACE, "codigoIBGE": "0012345"})]})
    assert frame.collect()[0]["municipio_codigo_ibge"] == "0012345"


def test_malformed_values_fail(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        staged(spark, {FIRST: [agreement(1, valor="abc")]}).collect()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staged(spark, {FIRST: [agreement(1, dataPublicacao="10/03/2026")]}).collect()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staged(spark, {FIRST: [agreement("x1")]}).collect()


def test_large_money_is_exact(spark):
    raw = spark.createDataFrame(
        [('{"id": 1, "valor": 9999999999999999.99}',)], "dado string"
    )
    value = staging.parse_documents(raw, AGREEMENT_FIELDS).collect()[0]["valor"]
    assert value == Decimal("9999999999999999.99")


def test_files_and_raw_table_agree(spark, folder):
    path = f"{folder}/convenios.jsonl"
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join(lines([agreement(1), agreement(2, valor=7.5)])))
    nested = read_jsonl(spark, path, document_schema(AGREEMENT_FIELDS))
    from_files = staging.stg_convenios_from_files(nested, AS_OF, FIRST)
    from_raw = staged(spark, {FIRST: [agreement(1), agreement(2, valor=7.5)]})
    assert from_files.schema == from_raw.schema
    assert sorted(from_files.collect()) == sorted(from_raw.collect())


def test_malformed_line_fails_the_read(spark, folder):
    path = f"{folder}/bad.jsonl"
    with open(path, "w", encoding="utf-8") as out:
        out.write('{"id": 1}\n{bad\n')
    with pytest.raises(Exception, match="MALFORMED"):
        read_jsonl(spark, path, document_schema(AGREEMENT_FIELDS)).collect()


def test_dimension_keeps_one_spelling(spark):
    rows = [
        agreement(9),
        agreement(10, municipioConvenente={**PLACE, "nomeIBGE": "Aquidauana"}),
        agreement(11, municipioConvenente={**PLACE, "nomeRegiao": "Sul"}),
    ]
    stg = staged(spark, {FIRST: rows})
    geo = dimensions.dim_municipio(stg)
    assert [(r["codigo_ibge"], r["nome_municipio"], r["nome_regiao"]) for r in geo.collect()] == [
        ("5001102", "AQUIDAUANA", "Centro-Oeste")
    ]
    fact = facts.fct_convenios(stg, geo, dimensions.dim_orgao_superior(stg))
    assert fact.count() == 3 and fact.where("sk_municipio is null").count() == 0


def test_uncovered_key_surfaces_as_null(spark):
    stg = staged(spark, {FIRST: [agreement(1)]})
    fact = facts.fct_convenios(stg, dimensions.dim_municipio(stg.limit(0)), dimensions.dim_orgao_superior(stg))
    row = fact.collect()[0]
    assert row["sk_municipio"] is None and row["sk_orgao_superior"] is not None


def test_amendments(spark):
    rows = [
        amendment("a"),
        amendment("a"),
        amendment("b", nomeAutor=None),
        amendment("c", valorEmpenhado=""),
        amendment("d", valorEmpenhado="0,00"),
        amendment("e", valorPago="2.000,00"),
        amendment("f", tipoEmenda=None),
        amendment("g", tipoEmenda="INDIVIDUAL"),
        amendment("h", tipoEmenda="Emenda de Bancada", nomeAutor="BANCADA"),
    ]
    stg = staging.stg_emendas(documents(spark, rows))
    assert stg.columns == [name for _, name, _ in AMENDMENT_FIELDS]
    assert sorted(r["codigo_emenda"] for r in stg.collect()) == ["a", "a", "d", "e", "f", "g", "h"]
    author = dimensions.dim_autor_emenda(stg)
    flags = {(r["nome_autor"], r["tipo_emenda"]): r["eh_parlamentar_individual"] for r in author.collect()}
    assert flags == {
        ("FULANO", "Emenda Individual - Transferências Especiais"): True,
        ("FULANO", "INDIVIDUAL"): True,
        ("FULANO", None): None,
        ("BANCADA", "Emenda de Bancada"): False,
    }
    fact = {r["codigo_emenda"]: r for r in facts.fct_emendas(stg, author).collect()}
    assert fact["d"]["taxa_execucao"] is None
    assert fact["e"]["taxa_execucao"] == 2.0
    assert fact["a"]["valor_resto_cancelado"] == Decimal("-721.68")
    assert fact["a"]["valor_resto_pago"] is None
    assert fact["f"]["sk_autor_emenda"] is None


def hot_rows(spark, n=30_000):
    """A third of the rows share one key and another share of keys is null."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 500).alias("k"),
        (F.hash("id") % 1000).alias("t"),
        F.concat(F.lit("n"), (F.col("id") % 13).cast("string")).alias("name"),
    )


def test_hot_key_versions_match_brute_force(spark):
    rows = hot_rows(spark)
    best = {}
    for row in rows.collect():
        rank = (-row["t"], row["name"])
        if row["k"] not in best or rank < best[row["k"]]:
            best[row["k"]] = rank
    found = latest_version(rows, ["k"], ["t"])
    assert {r["k"]: (-r["t"], r["name"]) for r in found.collect()} == best


def test_hot_key_is_cut_before_the_exchange(spark):
    plan = latest_version(hot_rows(spark), ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 1, Partial")
    exchange = plan.index("Exchange hashpartitioning(k")
    assert exchange < partial, "the plan prints consumers first: the partial limit must feed the exchange"


def test_representative_puts_nulls_last(spark):
    rows = spark.createDataFrame([("a", None), ("a", "z"), ("a", "Z")], "k string, n string")
    assert [tuple(r) for r in representative(rows, ["k"], ["n"]).collect()] == [("a", "Z")]
