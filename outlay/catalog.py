"""Registered queries: the library's operators on the provided tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outlay.config import Config
from outlay.functions.dates import (
    as_date,
    br_date,
    month_label,
    month_start,
    parse_br_date,
)
from outlay.functions.display import (
    compact_currency,
    format_reais,
    full_currency,
    integer_text,
    month_name,
    percent_text,
    released_share,
)
from outlay.functions.money import brl_decimal
from outlay.operators.quality import (
    DataTest,
    accepted_values_failures,
    non_negative_failures,
    run_tests,
    unique_failures,
)
from outlay.operators.versions import latest_version, representative
from outlay.plans import dashboard, facts, newest, products, rollup, staging
from outlay.plans.contract import CONTRACT
from outlay.plans.interval import product_tables, run_interval
from outlay.schemas import AGREEMENT_FIELDS, MONEY, MONEY_TOTAL, document_schema
from outlay.session import RELEASED_SHUFFLES, new_work_path, run_together, setting
from outlay.sources import raw, windows
from outlay.sources.documents import read_json_product, stamped, write_json_object, write_json_product
from outlay.sources.landing import ingest_records, landing_path, read_jsonl, write_landing
from outlay.sources.marts import MARTS, ROLLUP, TableFolder
from outlay.standin import (
    AS_OF,
    INDIVIDUAL_PATTERN,
    Marts,
    agreement_documents,
    amendment_documents,
    brl_text,
    documents,
    table,
    typed_agreements,
)
from outlay.streaming.landing import load_landed_intervals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed parameters of the filtered queries.
REGION = "ASIA"
STATE = "NATION_7"
STATE_CODE = "N7"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- parsing and typing -------------------------------------------------------


@query
def flat_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text to typed columns; a path the document lacks is null."""
    fields = (("k", "k", "int"), ("missing.leaf", "ausente", "string"))
    events = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("dado"))
    return staging.parse_documents(events, fields, ("event_id",))


@query
def staged_agreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole staging path: nested documents, one parse, casts, newest version, filters."""
    return staging.stg_convenios(Marts.of(spark, sf_dir)["raw_convenios"], AS_OF).drop("carregado_em")


@query
def staged_amendments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole staging path of amendments, money given as Brazilian-format text."""
    return staging.stg_emendas(Marts.of(spark, sf_dir)["raw_emendas"])


@query
def brl_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Money text in the shapes the source uses, back to decimals."""
    price = F.col("o_totalprice")
    text = (
        F.when(F.col("o_orderstatus") == "F", brl_text(price))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("- "), brl_text(price)))
        .otherwise(price.cast(MONEY).cast("string"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.alias("texto"), brl_decimal(text).alias("valor"),
        brl_decimal(F.replace(text, F.lit("."), F.lit("x")), strict=False).alias("valor_tolerante"),
    )


# --- newest versions ----------------------------------------------------------


def _item_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_version(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            F.col("l_shipdate").cast("date").alias("l_shipdate"),
            "l_partkey",
            "l_suppkey",
            "l_returnflag",
        ),
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey"],
    )


@query
def latest_version_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _item_versions(spark, sf_dir)


@query
def latest_then_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filters see only newest versions; an older match does not count."""
    return _item_versions(spark, sf_dir).where(
        F.col("l_returnflag").isNotNull() & (F.col("l_shipdate") >= as_date("1998-01-01"))
    )


# --- star schema --------------------------------------------------------------


@query
def dim_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Marts.of(spark, sf_dir).plan("dim_municipio")


@query
def dim_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Marts.of(spark, sf_dir).plan("dim_orgao_superior")


@query
def dim_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Marts.of(spark, sf_dir).plan("dim_autor_emenda")


@query
def dim_election_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Marts.of(spark, sf_dir).plan("dim_ano_eleitoral")


@query
def fct_agreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact over dimensions given as tables; the mart computes the same keys without joins."""
    marts = Marts.of(spark, sf_dir)
    return facts.fct_convenios(marts["stg_convenios"], marts["dim_municipio"], marts["dim_orgao_superior"])


@query
def fct_amendments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Marts.of(spark, sf_dir).plan("fct_emendas")


# --- data products ------------------------------------------------------------


def _flat_kpis(row: DataFrame) -> DataFrame:
    return row.select(
        "total_valor",
        "total_valor_liberado",
        "numero_convenios",
        "numero_municipios",
        "numero_orgaos",
        "periodo_inicio",
        "periodo_fim",
        F.col("orgao_maior_gasto.nome").alias("orgao_maior_gasto_nome"),
        F.col("orgao_maior_gasto.valor").alias("orgao_maior_gasto_valor"),
        F.col("mes_pico.mes").alias("mes_pico_mes"),
        F.col("mes_pico.valor").alias("mes_pico_valor"),
    )


@query
def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = Marts.of(spark, sf_dir)
    return _flat_kpis(products.kpis(marts["fct_convenios"], marts["dim_orgao_superior"]))


@query
def kpis_filtered_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No agreement qualifies: still one row, counts 0 and the rest null."""
    marts = Marts.of(spark, sf_dir)
    return _flat_kpis(products.kpis(marts["fct_convenios"].where("valor < 0"), marts["dim_orgao_superior"]))


@query
def ranking_agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = Marts.of(spark, sf_dir)
    return products.ranking_orgaos(marts["fct_convenios"], marts["dim_orgao_superior"])


@query
def monthly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.serie_temporal(Marts.of(spark, sf_dir)["fct_convenios"])


@query
def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = Marts.of(spark, sf_dir)
    return products.municipios(marts["fct_convenios"], marts["dim_municipio"])


@query
def kpis_amendments(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = Marts.of(spark, sf_dir)
    return products.kpis_emendas(marts["fct_emendas"], marts["dim_autor_emenda"])


@query
def ranking_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = Marts.of(spark, sf_dir)
    return products.ranking_parlamentares(marts["fct_emendas"], marts["dim_autor_emenda"])


@query
def amendments_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = Marts.of(spark, sf_dir)
    return products.emendas_por_ano(marts["fct_emendas"], marts["dim_ano_eleitoral"])


@query
def json_product_municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The municipality product written as a JSON document and read back."""
    path = new_work_path(spark, "product")
    write_json_product(municipalities(spark, sf_dir), path, ["codigo_ibge"])
    schema = (
        "codigo_ibge string, nome string, uf_sigla string, uf_nome string, regiao string, "
        "valor_total double, numero_convenios bigint"
    )
    return read_json_product(spark, path, schema)


@query
def json_product_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The author product, whose rows are told apart by two columns, written and read back."""
    path = new_work_path(spark, "product")
    write_json_product(ranking_authors(spark, sf_dir), path, ["nome", "tipo_emenda"])
    schema = (
        "nome string, tipo_emenda string, individual boolean, valor_empenhado double, valor_pago double, "
        "valor_resto_cancelado double, numero_emendas bigint"
    )
    return read_json_product(spark, path, schema)


@query
def json_product_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When the totals were made, read back from the written object as text and as a point in time."""
    marts, path = Marts.of(spark, sf_dir), new_work_path(spark, "product")
    totals = products.kpis(marts["fct_convenios"], marts["dim_orgao_superior"])
    write_json_object(stamped(totals, f"{AS_OF} 06:00:00"), path)
    read = spark.read.schema("numero_convenios bigint, gerado_em string").json(path)
    return read.select("numero_convenios", "gerado_em", F.to_timestamp("gerado_em").alias("momento"))


@query
def json_product_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals written as one nested JSON object and read back."""
    marts, path = Marts.of(spark, sf_dir), new_work_path(spark, "product")
    write_json_object(products.kpis(marts["fct_convenios"], marts["dim_orgao_superior"]), path)
    schema = (
        "total_valor double, total_valor_liberado double, numero_convenios bigint, numero_municipios bigint, "
        "numero_orgaos bigint, periodo_inicio date, periodo_fim date, "
        "orgao_maior_gasto struct<nome string, valor double>, mes_pico struct<mes string, valor double>"
    )
    return _flat_kpis(spark.read.schema(schema).option("mode", "FAILFAST").json(path))


# --- dashboard and site -------------------------------------------------------


@query
def dash_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answered from the rollup, as are the ranking and the series."""
    return rollup.rollup_kpis(Marts.of(spark, sf_dir)[ROLLUP], regiao=REGION)


@query
def dash_kpis_unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rollup_kpis(Marts.of(spark, sf_dir)[ROLLUP], regiao=None, uf=None)


@query
def dash_kpis_from_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals from the fact, two filters at once."""
    marts = Marts.of(spark, sf_dir)
    return dashboard.dashboard_kpis(marts["fct_convenios"], marts["dim_municipio"], regiao=REGION, uf=STATE)


@query
def scope_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the rollup."""
    return Marts.of(spark, sf_dir)[ROLLUP]


@query
def dash_kpis_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named markers: two unset, one set."""
    marts = Marts.of(spark, sf_dir)
    return dashboard.sql_dashboard_kpis(spark, marts["fct_convenios"], marts["dim_municipio"], uf=STATE)


@query
def dash_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rollup_ranking(Marts.of(spark, sf_dir)[ROLLUP], regiao=REGION)


@query
def dash_ranking_from_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = Marts.of(spark, sf_dir)
    return dashboard.dashboard_ranking(
        marts["fct_convenios"], marts["dim_orgao_superior"], marts["dim_municipio"], regiao=REGION
    )


@query
def dash_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rollup_serie(Marts.of(spark, sf_dir)[ROLLUP], regiao=REGION, uf=STATE)


@query
def dash_series_from_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = Marts.of(spark, sf_dir)
    return dashboard.dashboard_serie(marts["fct_convenios"], marts["dim_municipio"], regiao=REGION, uf=STATE)


@query
def dash_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = Marts.of(spark, sf_dir)
    return dashboard.dashboard_emendas_ano(marts["fct_emendas"], marts["dim_ano_eleitoral"])


@query
def dash_year_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.emendas_ano_long(dash_year(spark, sf_dir))


@query
def year_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.year_sentence(dash_year(spark, sf_dir))


@query
def geo_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.municipality_table(Marts.of(spark, sf_dir)["dim_municipio"])


@query
def geo_options_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.region_options(Marts.of(spark, sf_dir)["dim_municipio"])


@query
def geo_options_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.state_options(Marts.of(spark, sf_dir)["dim_municipio"], REGION)


@query
def geo_options_municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.municipality_options(Marts.of(spark, sf_dir)["dim_municipio"], STATE_CODE)


@query
def geo_names_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.state_names(Marts.of(spark, sf_dir)["dim_municipio"], REGION)


@query
def geo_names_municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.municipality_names(Marts.of(spark, sf_dir)["dim_municipio"], REGION, STATE)


@query
def top15_agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.top_agencies(ranking_agencies(spark, sf_dir))


@query
def top20_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.municipios_top(municipalities(spark, sf_dir), regiao=REGION)


@query
def top15_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.top_authors(ranking_authors(spark, sf_dir))


@query
def authors_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.authors_table(ranking_authors(spark, sf_dir), sort="taxa_execucao")


@query
def authors_sorted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.authors_table(ranking_authors(spark, sf_dir), only_individual=False, sort="nome")


@query
def kpi_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = Marts.of(spark, sf_dir)
    return dashboard.kpi_texts(products.kpis(marts["fct_convenios"], marts["dim_orgao_superior"]))


@query
def kpi_texts_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = Marts.of(spark, sf_dir)
    nothing = marts["fct_convenios"].where("valor < 0")
    return dashboard.kpi_texts(products.kpis(nothing, marts["dim_orgao_superior"]))


@query
def kpi_amendment_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.kpi_emendas_texts(kpis_amendments(spark, sf_dir))


@query
def series_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.serie_texts(monthly_series(spark, sf_dir))


@query
def authors_table_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.authors_table_texts(authors_sorted(spark, sf_dir))


@query
def authors_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many authors the table has, and its note, when it lists a part and when it lists all."""
    ranked = ranking_authors(spark, sf_dir)
    return dashboard.authors_note(ranked).unionByName(dashboard.authors_note(ranked, False, 1_000_000_000))


@query
def top15_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ranking that the list's length really cuts: customers in the place of agencies."""
    sums = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("codigo")).agg(
        F.sum(F.col("o_totalprice").cast(MONEY)).cast(MONEY_TOTAL).alias("valor_total")
    )
    named = sums.withColumn("nome", F.concat(F.lit("Cliente "), F.col("codigo").cast("string"))).withColumn("sigla", F.lit(""))
    return dashboard.top_agencies(named)


@query
def representative_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of several spellings per key: the status and flag pairs of a part's line items."""
    spellings = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus", "l_linenumber")
    return representative(spellings, ["l_partkey"], ["l_returnflag", "l_linestatus"])


@query
def sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a user of SQL asks of the marts by name: grouped and ordered by position."""
    marts = Marts.of(spark, sf_dir)
    for name in ("fct_convenios", "dim_municipio"):
        marts[name].createOrReplaceTempView(f"vista_{name}")
    return spark.sql(
        "select m.nome_regiao, year(f.mes_referencia) as ano, cast(sum(f.valor) as decimal(38, 2)) as valor, "
        "count(*) as numero from vista_fct_convenios f join vista_dim_municipio m using (sk_municipio) "
        "group by 1, 2 order by 1, 2"
    )


# --- display text -------------------------------------------------------------


@query
def format_brl(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        format_reais(price / 1000).alias("unidades"),
        format_reais(price).alias("milhares"),
        format_reais(price * 1000).alias("milhoes"),
        format_reais(price * 1000000).alias("bilhoes"),
        format_reais(F.nullif(price, price)).alias("nulo"),
    )


@query
def site_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Currency, integer and percent texts of every amendment."""
    return Marts.of(spark, sf_dir)["fct_emendas"].select(
        "codigo_emenda",
        "valor_empenhado",
        compact_currency(F.col("valor_empenhado")).alias("compacto"),
        compact_currency((F.col("valor_empenhado") * -1000).cast(MONEY)).alias("compacto_negativo"),
        full_currency(F.col("valor_pago")).alias("cheio"),
        integer_text(F.col("ano") * 1000).alias("inteiro"),
        percent_text(F.col("taxa_execucao")).alias("percentual"),
    )


@query
def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        month_label(day).alias("mes"),
        month_name(day).alias("mes_nome"),
        month_start(day).alias("mes_inicio"),
        br_date(day).alias("data_br"),
        parse_br_date(br_date(day)).alias("data_lida"),
    )


@query
def released_share_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = Marts.of(spark, sf_dir)["fct_convenios"].groupBy("sk_municipio").agg(
        products.total("valor").alias("valor"), products.total("valor_liberado").alias("liberado")
    )
    return sums.select("sk_municipio", released_share(F.col("liberado"), F.col("valor")).alias("percentual"))


# --- load plans ---------------------------------------------------------------


def _event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("dia", F.col("ts").cast("date"))


@query
def date_windows_28(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that cover all orders, with the orders of each."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("dia"))
    bounds = orders.agg(F.min("dia").alias("inicio"), F.max("dia").alias("fim"))
    first_day = bounds.select("inicio").scalar()
    counts = orders.groupBy(windows.window_start(F.col("dia"), first_day).alias("janela_inicio")).agg(
        F.count(F.lit(1)).alias("registros")
    )
    return (
        windows.split_windows(bounds, "inicio", "fim")
        .join(counts, "janela_inicio", "left")
        .select("janela_inicio", "janela_fim", F.coalesce("registros", F.lit(0)).alias("registros"))
    )


@query
def default_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default and rolling window of the newest order day, with the orders in each."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("dia"))
    newest = orders.agg(F.max("dia").alias("dia"))
    day = F.col("dia")

    def window(name: str, bounds: tuple[Column, Column]) -> DataFrame:
        start, end = bounds
        return orders.where(day.between(start, end)).agg(F.count(F.lit(1)).alias("registros")).select(
            F.lit(name).alias("janela"), start.alias("inicio"), end.alias("fim"), "registros"
        )

    as_of = newest.scalar()
    return window("padrao", windows.default_window(as_of)).unionByName(
        window("rolante", windows.rolling_window(as_of))
    )


@query
def refresh_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which years a snapshot load asks for by default, on refresh and by an explicit list."""
    days = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("dia"))
    as_of = days.agg(F.max("dia")).scalar()
    per_year = days.groupBy(F.year("dia").alias("ano")).agg(F.count(F.lit(1)).alias("registros"))
    return per_year.select(
        "ano",
        F.array_contains(windows.default_years(as_of), F.col("ano")).alias("padrao"),
        F.array_contains(windows.refresh_years(as_of), F.col("ano")).alias("atualizacao"),
        F.array_contains(windows.parse_years(F.lit("1996, 1999,, 2000 ")), F.col("ano")).alias("lista"),
        "registros",
    )


# --- loads --------------------------------------------------------------------


def _event_documents(events: DataFrame) -> DataFrame:
    return events.select(F.to_json(F.struct("event_id", "event_type", "value")).alias("dado"))


def _event_windows(spark: SparkSession, sf_dir: str) -> list[tuple[date, date]]:
    """A few windows, one load each: the list of loads is the driver's to walk."""
    bounds = _event_days(spark, sf_dir).agg(F.min("dia").alias("inicio"), F.max("dia").alias("fim"))
    rows = windows.split_windows(bounds, "inicio", "fim").orderBy("janela_inicio").collect()
    return [(row["janela_inicio"], row["janela_fim"]) for row in rows]


def _loaded_events(spark: SparkSession, sf_dir: str) -> tuple[str, list[tuple[date, date]], list[raw.LoadReport]]:
    path, plan, reports = new_work_path(spark, "raw"), _event_windows(spark, sf_dir), []
    events = _event_days(spark, sf_dir)
    for start, end in plan:
        rows = events.where(F.col("dia").between(F.lit(start), F.lit(end)))
        reports.append(raw.load_window(_event_documents(rows), path, start, end, "2024-02-01 00:00:00"))
    return path, plan, reports


EVENT_FIELDS = (("event_id", "event_id", "bigint"), ("event_type", "event_type", "string"))


def _raw_events(spark: SparkSession, path: str) -> DataFrame:
    rows = raw.read_raw_agreements(spark, path)
    return staging.parse_documents(rows, EVENT_FIELDS, ("carregado_em", "janela_inicio", "janela_fim"))


@query
def load_window_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows loaded, then the first one again with fewer rows: it is replaced, not added to."""
    path, plan, _ = _loaded_events(spark, sf_dir)
    start, end = plan[0]
    again = _event_days(spark, sf_dir).where(
        F.col("dia").between(F.lit(start), F.lit(end)) & (F.col("event_type") != "error")
    )
    raw.load_window(_event_documents(again), path, start, end, "2024-02-02 00:00:00")
    return _raw_events(spark, path).select("event_id", "event_type", "janela_inicio", "janela_fim")


@query
def load_overlapping_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rolling window over loaded days leaves two copies in raw and one newest version."""
    path, plan, _ = _loaded_events(spark, sf_dir)
    end = plan[-1][1]
    start = end - timedelta(days=windows.ROLLING_DAYS - 1)
    again = _event_days(spark, sf_dir).where(F.col("dia").between(F.lit(start), F.lit(end)))
    raw.load_window(_event_documents(again), path, start, end, "2024-02-02 00:00:00")
    newest = latest_version(_raw_events(spark, path), ["event_id"], ["carregado_em", "janela_fim", "janela_inicio"])
    return newest.select("event_id", "event_type", "janela_inicio", "janela_fim")


@query
def load_empty_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty extract clears exactly its own window."""
    path, plan, _ = _loaded_events(spark, sf_dir)
    start, end = plan[-1]
    nothing = _event_documents(_event_days(spark, sf_dir).where(F.lit(False)))
    raw.load_window(nothing, path, start, end, "2024-02-02 00:00:00")
    return _raw_events(spark, path).select("event_id", "janela_inicio", "janela_fim")


@query
def load_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each load removed and inserted: first loads, a replay, an empty replay."""
    path, plan, reports = _loaded_events(spark, sf_dir)
    start, end = plan[0]
    in_window = _event_days(spark, sf_dir).where(F.col("dia").between(F.lit(start), F.lit(end)))
    again = _event_documents(in_window.where("event_type <> 'error'"))
    reports.append(raw.load_window(again, path, start, end, "2024-02-02 00:00:00"))
    nothing = _event_documents(in_window.where(F.lit(False)))
    reports.append(raw.load_window(nothing, path, start, end, "2024-02-03 00:00:00"))
    return raw.load_report(spark, *reports).select(
        F.col("table").alias("tabela"), F.col("removed").alias("removidas"), F.col("inserted").alias("inseridas"),
        F.col("warning").isNotNull().alias("aviso"),
    )


def _item_documents(spark: SparkSession, sf_dir: str, factor: int = 1) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    price = (F.col("l_extendedprice").cast(MONEY) * factor).cast(MONEY)
    return items.select(
        F.to_json(F.struct(F.year("l_shipdate").alias("ano"), price.alias("valor"))).alias("dado"),
        F.year("l_shipdate").alias("ano"),
    )


def _year_totals(amendments: DataFrame) -> DataFrame:
    typed = staging.parse_documents(amendments, (("valor", "valor", MONEY),), ("ano_snapshot",))
    return typed.groupBy("ano_snapshot").agg(
        F.count(F.lit(1)).alias("registros"), F.sum("valor").cast(MONEY_TOTAL).alias("valor")
    )


@query
def load_snapshot_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All years loaded, then two of them again at triple value; the others stay."""
    path = new_work_path(spark, "raw")
    raw.load_snapshot(_item_documents(spark, sf_dir).select("dado"), path, "2001-08-01 00:00:00")
    again = _item_documents(spark, sf_dir, 3).where(F.col("ano").isin(1999, 2000)).select("dado")
    raw.load_snapshot(again, path, "2001-08-02 00:00:00")
    return _year_totals(raw.read_raw_amendments(spark, path))


@query
def load_snapshot_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty snapshot names no year, so it removes nothing."""
    path = new_work_path(spark, "raw")
    documents = _item_documents(spark, sf_dir)
    raw.load_snapshot(documents.select("dado"), path, "2001-08-01 00:00:00")
    raw.load_snapshot(documents.where(F.lit(False)).select("dado"), path, "2001-08-02 00:00:00")
    return _year_totals(raw.read_raw_amendments(spark, path))


@query
def load_snapshot_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one line number name no year; loaded twice they are there once."""
    path = new_work_path(spark, "raw")
    items = table(spark, sf_dir, "lineitem")
    year = F.when(F.col("l_linenumber") != 1, F.year("l_shipdate"))
    documents = items.select(
        F.to_json(F.struct(year.alias("ano"), F.col("l_extendedprice").cast(MONEY).alias("valor"))).alias("dado")
    )
    for day in ("01", "02"):
        raw.load_snapshot(documents, path, f"2001-08-{day} 00:00:00")
    return _year_totals(raw.read_raw_amendments(spark, path))


@query
def evolve_then_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table from before the year column, then a load of one year at triple value into it."""
    path = new_work_path(spark, "raw")
    _item_documents(spark, sf_dir).select("dado", F.lit("2001-08-01").cast("timestamp").alias("carregado_em")).write.parquet(path)
    again = _item_documents(spark, sf_dir, 3).where("ano = 1999").select("dado")
    raw.load_snapshot(again, path, "2001-08-02 00:00:00")
    return _year_totals(raw.read_raw_amendments(spark, path))


@query
def evolve_year_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table from before the year column gets it, filled from its documents."""
    old, new = new_work_path(spark, "raw"), new_work_path(spark, "raw")
    _item_documents(spark, sf_dir).select("dado").write.parquet(old)
    raw.evolve_add_column(
        spark.read.parquet(old), new, "ano_snapshot", raw.document_year(F.col("dado")), ("ano_snapshot",)
    )
    return _year_totals(raw.read_raw_amendments(spark, new))


@query
def landing_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as JSON Lines of one interval, read back nested and flattened."""
    base = new_work_path(spark, "landing")
    parsed = agreement_documents(spark, sf_dir).select(
        F.from_json("dado", document_schema(AGREEMENT_FIELDS)).alias("doc")
    )
    path = write_landing(parsed.select("doc.*"), base, AS_OF)
    nested = read_jsonl(spark, path, document_schema(AGREEMENT_FIELDS))
    return nested.select(*staging.flatten(AGREEMENT_FIELDS))


@query
def landing_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines as raw documents; blank lines are no records."""
    path = new_work_path(spark, "landing")
    events = _event_days(spark, sf_dir)
    line = F.when(F.col("event_type") == "error", "   ").otherwise(F.to_json(F.struct("event_id", "event_type")))
    events.select(line.alias("value")).write.text(path)
    return staging.parse_documents(ingest_records(spark, path), EVENT_FIELDS)


@query
def load_streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed intervals loaded by the stream; each names its window by its last day."""
    base, path = new_work_path(spark, "landing"), new_work_path(spark, "raw")
    events = _event_days(spark, sf_dir)
    for start, end in _event_windows(spark, sf_dir):
        rows = events.where(F.col("dia").between(F.lit(start), F.lit(end)))
        write_landing(rows.select("event_id", "event_type"), base, end)
    stream = load_landed_intervals(
        spark, base, path, new_work_path(spark, "stream"), "2024-02-01 00:00:00", windows.WINDOW_DAYS
    )
    stream.awaitTermination()
    return _raw_events(spark, path).select("event_id", "event_type", "janela_inicio", "janela_fim")


@query
def load_streamed_late_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every interval lands in two parts with a run of the stream between them: all windows end up whole."""
    base, path, seen = new_work_path(spark, "landing"), new_work_path(spark, "raw"), new_work_path(spark, "stream")
    events = _event_days(spark, sf_dir)
    for part in ("event_type = 'error'", "event_type <> 'error'"):
        for start, end in _event_windows(spark, sf_dir):
            rows = events.where(part).where(F.col("dia").between(F.lit(start), F.lit(end)))
            lines = rows.select(F.to_json(F.struct("event_id", "event_type")).alias("value"))
            lines.write.mode("append").text(landing_path(base, end))
        load_landed_intervals(spark, base, path, seen, "2024-02-01 00:00:00", windows.WINDOW_DAYS).awaitTermination()
    return _raw_events(spark, path).select("event_id", "event_type", "janela_inicio", "janela_fim")


@query
def load_streamed_empty_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals loaded by the stream, the last one landed again without records: its window is cleared."""
    base, path, seen = new_work_path(spark, "landing"), new_work_path(spark, "raw"), new_work_path(spark, "stream")
    events, plan = _event_days(spark, sf_dir), _event_windows(spark, sf_dir)

    def run() -> None:
        load_landed_intervals(spark, base, path, seen, "2024-02-01 00:00:00", windows.WINDOW_DAYS).awaitTermination()

    for start, end in plan:
        rows = events.where(F.col("dia").between(F.lit(start), F.lit(end)))
        write_landing(rows.select("event_id", "event_type"), base, end)
    run()
    write_landing(events.select("event_id", "event_type").where(F.lit(False)), base, plan[-1][1])
    run()
    return _raw_events(spark, path).select("event_id", "event_type", "janela_inicio", "janela_fim")


@query
def load_reader_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader opened before two loads sees all old rows, one opened after them all new ones."""
    path, plan, _ = _loaded_events(spark, sf_dir)
    before = _raw_events(spark, path)
    (start, end), last = plan[0], plan[-1]
    again = _event_days(spark, sf_dir).where(
        F.col("dia").between(F.lit(start), F.lit(end)) & (F.col("event_type") != "error")
    )
    raw.load_window(_event_documents(again), path, start, end, "2024-02-02 00:00:00")
    raw.load_window(_event_documents(again.where(F.lit(False))), path, *last, "2024-02-02 00:00:00")
    columns = ("event_id", "event_type", "janela_inicio", "janela_fim")
    return before.select(F.lit("antes").alias("leitura"), *columns).unionByName(
        _raw_events(spark, path).select(F.lit("depois").alias("leitura"), *columns)
    )


@query
def load_cut_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of all windows that stop half-way, at the first row of one kind: the rows before them stay."""
    path, plan, _ = _loaded_events(spark, sf_dir)
    broken = F.when(F.col("event_type") == "error", F.raise_error(F.lit("cut off"))).otherwise(F.col("event_type"))
    for start, end in plan:
        rows = _event_days(spark, sf_dir).where(F.col("dia").between(F.lit(start), F.lit(end)))
        try:
            documents = _event_documents(rows.withColumn("event_type", broken))
            raw.load_window(documents, path, start, end, "2024-02-02 00:00:00")
        except (PySparkException, Py4JJavaError) as error:
            if "cut off" not in str(error):
                raise
    return _raw_events(spark, path).select("event_id", "event_type", "carregado_em", "janela_inicio", "janela_fim")


@query
def load_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows loaded side by side, each by two writers: every window stands once."""
    path, events = new_work_path(spark, "raw"), _event_days(spark, sf_dir)

    def load(start: date, end: date) -> None:
        rows = events.where(F.col("dia").between(F.lit(start), F.lit(end)))
        raw.load_window(_event_documents(rows), path, start, end, "2024-02-01 00:00:00")

    run_together([partial(load, *window) for window in _event_windows(spark, sf_dir) for _ in range(2)])
    return _raw_events(spark, path).select("event_id", "event_type", "janela_inicio", "janela_fim")


@query
def newest_kept_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest versions after three loads, brought up to date after each.

    A second window repeats the finished orders at double value; its replay
    leaves out one agency, whose orders fall back to the first window.
    """
    typed = typed_agreements(spark, sf_dir)
    doubled = typed.where("situacao = 'F'").withColumn("valor", (F.col("valor") * 2).cast(MONEY))
    log = raw.agreements_log(spark, new_work_path(spark, "raw"))
    state = newest.state_log(log, new_work_path(spark, "state"))
    loads = [
        (typed, "2001-07-01", "2001-07-07", "2001-07-08 06:00:00"),
        (doubled, "2001-07-02", "2001-07-08", "2001-07-09 06:00:00"),
        (doubled.where("orgao_superior_codigo <> '5-LOW'"), "2001-07-02", "2001-07-08", "2001-07-10 06:00:00"),
    ]
    for rows, start, end, stamp in loads:
        raw.load_window(documents(rows, AGREEMENT_FIELDS), log.path, start, end, stamp)
        current = newest.refresh(log, state)
    return staging.complete_and_recent(current, AS_OF).select("id_convenio", "valor", "situacao", "janela_fim")


# --- data tests ---------------------------------------------------------------


@query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All contract tests on the marts."""
    marts = Marts.of(spark, sf_dir)
    return run_tests({name: marts[name] for name in MARTS}, CONTRACT)


@query
def quality_report_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same kinds of tests where some must fail."""
    tests = [
        DataTest("unique", "lineitem", "l_orderkey"),
        DataTest("not_null", "lineitem", "l_shipdate"),
        DataTest("unique", "orders", "o_orderkey"),
        DataTest("accepted_values", "orders", "o_orderstatus", ("F", "O")),
        DataTest("non_negative", "customer", "c_acctbal"),
        DataTest("not_null", "customer", "c_name"),
    ]
    names = dict.fromkeys(test.table for test in tests)
    return run_tests({name: table(spark, sf_dir, name) for name in names}, tests)


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failing rows of a uniqueness test."""
    return unique_failures(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def unexpected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failing rows of an accepted-values test."""
    return accepted_values_failures(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"])


@query
def negative_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failing rows of a non-negative test."""
    return non_negative_failures(table(spark, sf_dir, "customer"), "c_acctbal")


# --- interval runs ------------------------------------------------------------


@query
def interval_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping interval runs, from landed files to the agency ranking.

    The second interval brings the finished orders again at double value; only
    their newest versions may count.
    """
    config = Config(date.fromisoformat(AS_OF), new_work_path(spark, "run"), INDIVIDUAL_PATTERN)
    previous = config.as_of - timedelta(days=1)
    documents = agreement_documents(spark, sf_dir).select("dado")
    schema = document_schema(AGREEMENT_FIELDS)
    parsed = documents.select(F.from_json("dado", schema).alias("doc")).select("doc.*")
    landed = read_jsonl(spark, write_landing(parsed, config.landing_agreements, previous, "gzip"), schema)
    doubled = landed.where("situacao = 'F'").withColumn(
        "valor", (F.col("valor").cast(MONEY) * 2).cast(MONEY).cast("string")
    )
    write_landing(doubled, config.landing_agreements, config.as_of, "gzip")
    amendments = amendment_documents(spark, sf_dir).select(F.col("dado").alias("value"))
    with setting(spark, *RELEASED_SHUFFLES):
        amendments.write.text(landing_path(config.landing_amendments, AS_OF), compression="gzip")
    run_interval(spark, config, f"{previous} 06:00:00", interval_end=previous, is_latest=False)
    run_interval(spark, config, f"{AS_OF} 06:00:00")
    return product_tables(TableFolder(spark, config.marts))["ranking_orgaos"]
