import datetime
import itertools
import json
from decimal import Decimal

import pytest
from fixtures import AGENCY, AS_OF, agreement, amendment, documents, raw_agreements
from pyspark.sql import functions as F

from outlay.operators.quality import DataTest, DataTestFailure, gate, run_tests
from outlay.operators.ranking import user_order
from outlay.plans import dashboard, dimensions, facts, products, rollup, staging
from outlay.plans.contract import CONTRACT
from outlay.sources.documents import read_json_product, utc_stamp, write_json_object, write_json_product
from outlay.sources.marts import TableFolder

NATAL = {
    "codigoIBGE": "2408102",
    "nomeIBGE": "NATAL",
    "codigoRegiao": "NE",
    "nomeRegiao": "Nordeste",
    "uf": {"sigla": "RN", "nome": "Rio Grande do Norte"},
}
EDUCATION = {**AGENCY, "orgaoMaximo": {"codigo": "26000", "nome": "Ministério da Educação", "sigla": ""}}
# Same name under another code: the top agency is asked by name.
EDUCATION_OLD = {**AGENCY, "orgaoMaximo": {"codigo": "26001", "nome": "Ministério da Educação", "sigla": None}}


@pytest.fixture(scope="module")
def star(spark):
    rows = [
        agreement(1, valor=100.0),
        agreement(2, valor=300.0, dataPublicacao="2026-04-01", municipioConvenente=NATAL),
        agreement(3, valor=250.0, dataPublicacao="2026-04-30", orgao=EDUCATION),
        agreement(4, valor=200.0, dataPublicacao="2026-05-02", orgao=EDUCATION_OLD, municipioConvenente=NATAL),
    ]
    stg = staging.stg_convenios(raw_agreements(spark, {"2026-07-01 06:00:00": rows}), AS_OF).persist()
    place, agency = dimensions.dim_municipio(stg), dimensions.dim_orgao_superior(stg)
    return {
        "fct_convenios": facts.fct_convenios(stg, place, agency).persist(),
        "dim_municipio": place.persist(),
        "dim_orgao_superior": agency.persist(),
    }


@pytest.fixture(scope="module")
def amendments(spark):
    rows = [
        amendment("a", ano=2024),
        amendment("b", ano=2025, valorEmpenhado="3.000,00", valorPago="3.000,00", valorRestoCancelado="10,00"),
        amendment("c", ano=2025, tipoEmenda="INDIVIDUAL"),
        amendment("d", ano=2026, tipoEmenda="Emenda de Bancada", nomeAutor="BANCADA", valorEmpenhado="0,00"),
    ]
    stg = staging.stg_emendas(documents(spark, rows)).persist()
    author = dimensions.dim_autor_emenda(stg)
    return {
        "fct_emendas": facts.fct_emendas(stg, author).persist(),
        "dim_autor_emenda": author.persist(),
        "dim_ano_eleitoral": dimensions.dim_ano_eleitoral(stg).persist(),
    }


def test_kpis(star):
    row = products.kpis(star["fct_convenios"], star["dim_orgao_superior"]).collect()[0].asDict(recursive=True)
    assert row == {
        "total_valor": Decimal("850.00"),
        "total_valor_liberado": Decimal("160.00"),
        "numero_convenios": 4,
        "numero_municipios": 2,
        "numero_orgaos": 3,
        "periodo_inicio": datetime.date(2026, 3, 10),
        "periodo_fim": datetime.date(2026, 5, 2),
        "orgao_maior_gasto": {"nome": "Ministério da Educação", "valor": Decimal("450.00")},
        "mes_pico": {"mes": "2026-04", "valor": Decimal("550.00")},
    }


def test_kpis_of_nothing(star):
    row = products.kpis(star["fct_convenios"].limit(0), star["dim_orgao_superior"]).collect()[0].asDict()
    assert {name: value for name, value in row.items() if value is not None} == {
        "numero_convenios": 0,
        "numero_municipios": 0,
        "numero_orgaos": 0,
    }


def test_kpis_emendas_of_nothing(amendments):
    row = products.kpis_emendas(amendments["fct_emendas"].limit(0), amendments["dim_autor_emenda"]).collect()[0]
    assert {name: value for name, value in row.asDict().items() if value is not None} == {
        "numero_emendas": 0,
        "numero_parlamentares_individuais": 0,
    }


def test_rankings_are_ordered_and_add_up(star):
    agencies = products.ranking_orgaos(star["fct_convenios"], star["dim_orgao_superior"]).collect()
    places = products.municipios(star["fct_convenios"], star["dim_municipio"]).collect()
    assert [(r["codigo"], r["valor_total"], r["numero_convenios"]) for r in agencies] == [
        ("36000", Decimal("400.00"), 2),
        ("26000", Decimal("250.00"), 1),
        ("26001", Decimal("200.00"), 1),
    ]
    assert [r["nome"] for r in places] == ["NATAL", "AQUIDAUANA"]
    assert sum(r["valor_total"] for r in agencies) == sum(r["valor_total"] for r in places) == Decimal("850.00")
    months = products.serie_temporal(star["fct_convenios"]).collect()
    assert [(r["mes"], r["numero_convenios"]) for r in months] == [("2026-03", 1), ("2026-04", 2), ("2026-05", 1)]


def test_orphans_leave_the_rankings(star):
    orphan = star["fct_convenios"].withColumn("sk_municipio", F.when(F.col("id_convenio") != 2, F.col("sk_municipio")))
    places = products.municipios(orphan, star["dim_municipio"]).collect()
    assert sum(r["numero_convenios"] for r in places) == 3


def test_amendment_products(amendments):
    fact, author = amendments["fct_emendas"], amendments["dim_autor_emenda"]
    row = products.kpis_emendas(fact, author).collect()[0]
    assert row["total_empenhado"] == Decimal("5000.00") and row["numero_emendas"] == 4
    # One person under two individual types counts twice, as published.
    assert row["numero_parlamentares_individuais"] == 2
    assert (row["ano_inicio"], row["ano_fim"]) == (2024, 2026)
    assert row["taxa_execucao_geral"] == 3750.0 / 5000.0
    years = products.emendas_por_ano(fact, amendments["dim_ano_eleitoral"]).collect()
    assert [r["ano"] for r in years] == [2024, 2025, 2026]
    for name, total in (
        ("valor_empenhado", "total_empenhado"),
        ("valor_pago", "total_pago"),
        ("valor_resto_cancelado", "total_cancelado"),
        ("numero_emendas", "numero_emendas"),
    ):
        assert sum(r[name] for r in years) == row[total]
    ranked = products.ranking_parlamentares(fact, author).collect()
    assert [(r["nome"], r["valor_empenhado"], r["taxa_execucao"]) for r in ranked] == [
        ("FULANO", Decimal("4000.00"), 3250.0 / 4000.0),
        ("FULANO", Decimal("1000.00"), 0.25),
        ("BANCADA", Decimal("0.00"), None),
    ]


def test_dashboard_filters(spark, star):
    fact, place, agency = star["fct_convenios"], star["dim_municipio"], star["dim_orgao_superior"]
    for filters, expected in (
        ({}, (Decimal("850.00"), 4, 2)),
        ({"regiao": "Nordeste"}, (Decimal("500.00"), 2, 1)),
        ({"regiao": "Nordeste", "uf": "Mato Grosso do Sul"}, (None, 0, 0)),
        ({"municipio": "AQUIDAUANA"}, (Decimal("350.00"), 2, 1)),
        ({"municipio": "Santa Bárbara d'Oeste"}, (None, 0, 0)),
    ):
        for frame in (
            dashboard.dashboard_kpis(fact, place, **filters),
            dashboard.sql_dashboard_kpis(spark, fact, place, **filters),
        ):
            row = frame.collect()[0]
            assert (row["valor_total"], row["numero_convenios"], row["numero_municipios"]) == expected
    top = dashboard.dashboard_ranking(fact, agency, place, n=1).collect()
    assert [(r["orgao"], r["valor_total"]) for r in top] == [("Ministério da Educação", Decimal("450.00"))]
    months = dashboard.dashboard_serie(fact, place, uf="Rio Grande do Norte").collect()
    assert [r["mes"] for r in months] == [datetime.date(2026, 4, 1), datetime.date(2026, 5, 1)]


def test_options_cascade(star):
    place = star["dim_municipio"]
    assert [r[0] for r in dashboard.region_options(place).collect()] == ["Centro-Oeste", "Nordeste"]
    assert [r["texto"] for r in dashboard.state_options(place, "Nordeste").collect()] == ["Rio Grande do Norte (RN)"]
    assert len(dashboard.state_options(place).collect()) == 2
    assert dashboard.municipality_options(place, None).collect() == []
    assert [tuple(r) for r in dashboard.municipality_options(place, "RN").collect()] == [("2408102", "NATAL")]


def test_site_tables(star, amendments):
    places = products.municipios(star["fct_convenios"], star["dim_municipio"])
    rows = dashboard.municipios_top(places, n=1).collect()
    assert [(r["rotulo"], r["encontrados"]) for r in rows] == [("NATAL (RN)", 2)]
    assert rows[0]["nota"] == "Mostrando os 1 maiores de 2 municípios encontrados no filtro atual."
    assert dashboard.municipios_top(places).collect()[0]["nota"] == "Mostrando 2 município(s) no filtro atual."
    agencies = products.ranking_orgaos(star["fct_convenios"], star["dim_orgao_superior"])
    assert [r["rotulo"] for r in dashboard.top_agencies(agencies).collect()] == [
        "MS", "Ministério da Educação", "Ministério da Educação",
    ]
    authors = products.ranking_parlamentares(amendments["fct_emendas"], amendments["dim_autor_emenda"])
    assert [r["nome"] for r in dashboard.authors_table(authors).collect()] == ["FULANO", "FULANO"]
    everyone = dashboard.authors_table(authors, only_individual=False, sort="taxa_execucao", direction="asc").collect()
    assert [r["taxa_execucao"] for r in everyone] == [0.25, 3250.0 / 4000.0, None]
    assert [r["nome"] for r in dashboard.top_authors(authors, False, 1).collect()] == ["FULANO"]


def test_text_sorts_by_the_portuguese_alphabet(spark):
    rows = spark.createDataFrame([("Zélia",), ("Álvaro",), ("Bruno",), ("ana",), (None,)], "nome string")
    assert [r[0] for r in user_order(rows, "nome", None, ("nome",), []).collect()] == [
        "Álvaro", "ana", "Bruno", "Zélia", None,
    ]
    assert [r[0] for r in user_order(rows, "nome", "desc", ("nome",), []).collect()][-1] is None
    with pytest.raises(ValueError, match="direction"):
        user_order(rows, "nome", "down", ("nome",), [])


def test_year_views(amendments):
    years = dashboard.dashboard_emendas_ano(amendments["fct_emendas"], amendments["dim_ano_eleitoral"])
    assert dashboard.year_sentence(years).collect()[0][0] == (
        "**2024**: Municipal, ano 2 do mandato federal · **2025**: Sem eleição, ano 3 do mandato federal · "
        "**2026**: Geral, ano 4 do mandato federal"
    )
    long = dashboard.emendas_ano_long(years)
    assert {r["medida"] for r in long.collect()} == {"Empenhado (prometido)", "Pago (entregue)"}
    assert long.count() == 6


def read_document(folder):
    import glob

    parts = sorted(glob.glob(f"{folder}/part-*"))
    return "".join(open(part, encoding="utf-8").read() for part in parts)


def test_json_documents(star, folder):
    kpi = products.kpis(star["fct_convenios"], star["dim_orgao_superior"])
    write_json_object(kpi, f"{folder}/kpis.json")
    document = json.loads(read_document(f"{folder}/kpis.json"))
    assert document["total_valor"] == 850.0 and document["mes_pico"] == {"mes": "2026-04", "valor": 550.0}
    assert document["periodo_inicio"] == "2026-03-10"
    write_json_object(products.kpis(star["fct_convenios"].limit(0), star["dim_orgao_superior"]), f"{folder}/none.json")
    empty = json.loads(read_document(f"{folder}/none.json"))
    assert empty["orgao_maior_gasto"] is None and empty["numero_convenios"] == 0 and "total_valor" in empty

    ranked = products.ranking_orgaos(star["fct_convenios"], star["dim_orgao_superior"])
    write_json_product(ranked, f"{folder}/ranking.json", ["codigo"])
    text = read_document(f"{folder}/ranking.json")
    assert "Ministério" in text
    rows = json.loads(text)
    assert [r["valor_total"] for r in rows] == [400.0, 250.0, 200.0] and rows[2]["sigla"] is None

    write_json_product(ranked.limit(0), f"{folder}/empty.json", ["codigo"])
    assert json.loads(read_document(f"{folder}/empty.json")) == []


def test_a_product_has_the_same_bytes_on_any_number_of_partitions(spark, folder):
    rows = spark.range(2000).select(F.col("id").alias("codigo"), (F.col("id") % 7).cast("decimal(18,2)").alias("valor"))
    setting, texts = spark.conf.get("spark.sql.shuffle.partitions"), []
    for n in ("1", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        ordered = rows.repartition(int(n)).orderBy(F.desc("valor"), "codigo")
        write_json_product(ordered, f"{folder}/{n}.json", ["codigo"])
        texts.append(read_document(f"{folder}/{n}.json"))
    spark.conf.set("spark.sql.shuffle.partitions", setting)
    assert texts[0] == texts[1]
    assert [r["codigo"] for r in json.loads(texts[0])] == [r["codigo"] for r in ordered.collect()]
    shown = "codigo long, valor double"
    assert sorted(read_json_product(spark, f"{folder}/50.json", shown).collect()) == sorted(
        tuple(r) for r in rows.select("codigo", F.col("valor").cast("double")).collect()
    )


def test_a_stamp_is_utc_with_its_offset():
    assert utc_stamp("2026-07-20 06:00:00") == utc_stamp("2026-07-20T03:00:00-03:00") == "2026-07-20T06:00:00+00:00"
    for wrong, error in (("2026-07-20", ValueError), ("soon after dawn", ValueError), (20260720, TypeError)):
        with pytest.raises(error):
            utc_stamp(wrong)


def test_contract(star, amendments):
    tables = {**star, **amendments}
    report = run_tests(tables, CONTRACT)
    assert report.count() == len(CONTRACT) == 22
    assert report.where("failures > 0").count() == 0
    gate(report)


def test_failing_tests_close_the_gate(spark, star, amendments):
    tables = {**star, **amendments}
    tables["fct_convenios"] = tables["fct_convenios"].withColumn(
        "valor", F.when(F.col("id_convenio") == 1, F.lit(None)).when(F.col("id_convenio") == 2, -1).otherwise(5)
    )
    tables["dim_ano_eleitoral"] = spark.createDataFrame(
        [(2024, "Municipal"), (2024, "Outra"), (None, "Outra"), (2025, None)], "ano int, tipo_eleicao string"
    )
    failures = {r["test"]: r["failures"] for r in run_tests(tables, CONTRACT).collect() if r["failures"]}
    assert failures == {
        "not_null_fct_convenios_valor": 1,
        "non_negative_fct_convenios_valor": 1,
        "unique_dim_ano_eleitoral_ano": 1,
        "not_null_dim_ano_eleitoral_ano": 1,
        "accepted_values_dim_ano_eleitoral_tipo_eleicao": 1,
    }
    with pytest.raises(DataTestFailure, match="unique_dim_ano_eleitoral_ano: 1"):
        gate(run_tests(tables, CONTRACT))


def test_unknown_test_kind(spark):
    with pytest.raises(ValueError, match="unknown"):
        run_tests({"t": spark.range(1)}, [DataTest("odd", "t", "id")])


def test_the_rollup_answers_as_the_fact_does(spark, star, folder):
    fact, place, agency = star["fct_convenios"], star["dim_municipio"], star["dim_orgao_superior"]
    marts = TableFolder(spark, folder)
    cube = marts.write("rollup_convenios", rollup.scope_rollup(fact, agency, place), rollup.LAYOUT)
    names = [None, *{r["nome_regiao"] for r in place.collect()}, "nowhere"]
    states = [None, *{r["uf_nome"] for r in place.collect()}]
    towns = [None, "", *{r["nome_municipio"] for r in place.collect()}]
    for regiao, uf, municipio in itertools.product(names, states, towns):
        filters = {"regiao": regiao, "uf": uf, "municipio": municipio}
        for found, expected in (
            (rollup.rollup_kpis(cube, **filters), dashboard.dashboard_kpis(fact, place, **filters)),
            (rollup.rollup_ranking(cube, 2, **filters), dashboard.dashboard_ranking(fact, agency, place, 2, **filters)),
            (rollup.rollup_serie(cube, **filters), dashboard.dashboard_serie(fact, place, **filters)),
        ):
            assert found.schema.simpleString() == expected.schema.simpleString()
            assert found.collect() == expected.collect(), filters


def test_a_rollup_query_reads_the_rows_of_one_level(spark, star, folder):
    marts = TableFolder(spark, folder)
    cube = marts.write(
        "rollup_convenios",
        rollup.scope_rollup(star["fct_convenios"], star["dim_orgao_superior"], star["dim_municipio"]),
        rollup.LAYOUT,
    )
    plan = rollup.rollup_serie(cube, regiao="Nordeste")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "(nivel" in plan.split("PartitionFilters")[1] and "PushedFilters: [IsNotNull(nome_regiao)" in plan


def test_agencies_and_months_move_together(spark, star):
    """One sum per place and one grouping of names for both: they would be two of each."""
    cube = rollup.scope_rollup(star["fct_convenios"], star["dim_orgao_superior"], star["dim_municipio"])
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(sk_municipio") <= 4 and plan.count("Expand [") == 2


def test_the_rollup_of_nothing_answers(spark, star):
    nothing = rollup.scope_rollup(star["fct_convenios"].limit(0), star["dim_orgao_superior"], star["dim_municipio"])
    assert tuple(rollup.rollup_kpis(nothing).first()) == (None, None, 0, 0)
    assert rollup.rollup_ranking(nothing).count() == 0 and rollup.rollup_serie(nothing, uf="X").count() == 0
