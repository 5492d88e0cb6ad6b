"""Spending concepts on the provided order tables.

Agreements are orders (municipality = customer, state = nation, agency = order
priority); amendments are line items (author = supplier, type = part type). The
mapping gives the staging columns; everything after it is the library's own
staging, dimension, fact and product code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outlay.plans import dimensions, facts, rollup, staging
from outlay.schemas import AGREEMENT_FIELDS, AMENDMENT_FIELDS, MONEY
from outlay.session import new_work_path
from outlay.sources.files import listing
from outlay.sources.marts import ROLLUP, TableFolder

# Fixed values of the stand-in: the day the run is for, and what marks a single author.
AS_OF = "2001-08-01"
INDIVIDUAL_PATTERN = "%standard%"
#: A small table may be one row group, which a single task reads, so its rows are dealt to so many
#: tasks by the key. From the size of a row group on a table comes in many parts and stays as it comes.
LANDED_PARTS = 32
ROW_GROUP_BYTES = 128 * 1024 * 1024


#: Provided tables the stand-in reads.
SOURCES = ("customer", "nation", "region", "orders", "lineitem", "part", "supplier")

_tables: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table; its schema is read once for the files as they are now."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path, listing(spark, path))
    if key not in _tables:
        _tables[key] = spark.read.parquet(path)
    return _tables[key]


def _money(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(MONEY)


def typed_agreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as agreements. Joins carry no hint: Spark checks the size of each side."""
    place = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    value = _money("o_totalprice")
    released = F.when(F.col("o_orderstatus") == "F", value).otherwise(F.lit(0).cast(MONEY))
    columns = {
        "id_convenio": F.col("o_orderkey"),
        "numero_processo": F.concat(F.lit("P-"), F.col("o_orderkey").cast("string")),
        "situacao": F.col("o_orderstatus"),
        "data_publicacao": day,
        "data_inicio_vigencia": day,
        "data_final_vigencia": F.date_add(day, 365),
        "valor": value,
        "valor_liberado": released,
        "valor_contrapartida": F.lit(0).cast(MONEY),
        "municipio_codigo_ibge": F.col("c_custkey").cast("string"),
        "municipio_nome": F.col("c_name"),
        "municipio_codigo_regiao": F.col("r_regionkey").cast("string"),
        "municipio_nome_regiao": F.col("r_name"),
        "municipio_uf_sigla": F.concat(F.lit("N"), F.col("n_nationkey").cast("string")),
        "municipio_uf_nome": F.col("n_name"),
        "orgao_codigo_siafi": F.col("o_orderpriority"),
        "orgao_nome": F.col("o_orderpriority"),
        "orgao_sigla": F.lit(""),
        "orgao_superior_codigo": F.col("o_orderpriority"),
        "orgao_superior_nome": F.col("o_orderpriority"),
        # One agency without an acronym, so the label falls back to its name.
        "orgao_superior_sigla": F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(
            F.substring("o_orderpriority", 1, 1)
        ),
        "carregado_em": F.col("o_orderdate"),
    }
    return orders.join(place, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        *[column.alias(name) for name, column in columns.items()]
    )


def typed_amendments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as amendments; discounts are what was not paid, returns what was cancelled."""
    items = table(spark, sf_dir, "lineitem").withColumn("ano", F.year("l_shipdate"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    price = _money("l_extendedprice")
    paid = (price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast(MONEY)
    returned = F.when(F.col("l_returnflag") == "R", price).otherwise(F.lit(0).cast(MONEY))
    columns = {
        "codigo_emenda": F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
        "numero_emenda": F.col("l_linenumber").cast("string"),
        "ano": F.col("ano"),
        "tipo_emenda": F.col("p_type"),
        "nome_autor": F.col("s_name"),
        "localidade_gasto": F.col("l_linestatus"),
        "funcao": F.col("l_returnflag"),
        "subfuncao": F.col("l_linestatus"),
        "valor_empenhado": price,
        "valor_liquidado": paid,
        "valor_pago": paid,
        "valor_resto_inscrito": (price - paid).cast(MONEY),
        "valor_resto_cancelado": returned,
        "valor_resto_pago": F.lit(0).cast(MONEY),
    }
    # The larger table first: what moves for it are the items, with keys in place of names.
    return (
        items.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select(*[column.alias(name) for name, column in columns.items()])
    )


def brl_text(amount: Column) -> Column:
    """Money as the amendments source writes it: ``1.234.567,89``."""
    return F.translate(F.format_number(amount, 2), ",.", ".,")


def documents(typed: DataFrame, fields, *keep: str) -> DataFrame:
    """Typed rows as the nested JSON documents they would have come from."""
    tree: dict = {}
    for path, name, kind in fields:
        node = tree
        *parents, leaf = path.split(".")
        for parent in parents:
            node = node.setdefault(parent, {})
        value = F.col(name)
        if kind == "brl":
            value = brl_text(value)
        node[leaf] = value

    def struct(node: dict) -> Column:
        return F.struct(
            *[(struct(child) if isinstance(child, dict) else child).alias(name) for name, child in node.items()]
        )

    return typed.select(F.to_json(struct(tree)).alias("dado"), *keep)


def agreement_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(typed_agreements(spark, sf_dir), AGREEMENT_FIELDS, "carregado_em")


def amendment_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(typed_amendments(spark, sf_dir), AMENDMENT_FIELDS)


class Marts:
    """The star schema over the provided tables.

    Each table is written to the shared folder the first time it is asked for
    and read back after that, as the products read the marts and never rebuild
    them. A changed file of a source table makes new marts.
    """

    _built: dict[tuple, "Marts"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.folder = TableFolder(spark, new_work_path(spark, "marts"))
        self._tables: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Marts":
        files = tuple(listing(spark, f"{sf_dir}/{name}.parquet") for name in SOURCES)
        key = (spark.sparkContext.applicationId, str(sf_dir), files)
        if key not in cls._built:
            cls._built[key] = cls(spark, sf_dir)
        return cls._built[key]

    def plan(self, name: str) -> DataFrame:
        """The rows of a table as a plan over its written inputs."""
        if name == "typed_convenios":
            return self._dealt(typed_agreements(self.spark, self.sf_dir), "orders", "id_convenio")
        if name == "typed_emendas":
            return self._dealt(typed_amendments(self.spark, self.sf_dir), "lineitem", "codigo_emenda")
        # Typed rows are made once per table that reads them, which costs less than to write them.
        if name == "raw_convenios":
            return documents(self.plan("typed_convenios"), AGREEMENT_FIELDS, "carregado_em")
        if name == "raw_emendas":
            return documents(self.plan("typed_emendas"), AMENDMENT_FIELDS)
        if name == "stg_convenios":
            return staging.current_agreements(self.plan("typed_convenios"), AS_OF)
        if name == "stg_emendas":
            return staging.complete_amendments(self.plan("typed_emendas"))
        if name == ROLLUP:
            return rollup.scope_rollup(self["fct_convenios"], self["dim_orgao_superior"], self["dim_municipio"])
        if name == "dim_municipio":
            return dimensions.dim_municipio(self["stg_convenios"])
        if name == "dim_orgao_superior":
            return dimensions.dim_orgao_superior(self["stg_convenios"])
        if name == "dim_autor_emenda":
            return dimensions.dim_autor_emenda(self["stg_emendas"], INDIVIDUAL_PATTERN)
        if name == "dim_ano_eleitoral":
            return dimensions.dim_ano_eleitoral(self["stg_emendas"])
        if name == "fct_convenios":
            return facts.fct_convenios(self["stg_convenios"])
        if name == "fct_emendas":
            return facts.fct_emendas(self["stg_emendas"])
        raise KeyError(name)

    def _dealt(self, rows: DataFrame, source: str, key: str) -> DataFrame:
        files = listing(self.spark, f"{self.sf_dir}/{source}.parquet")
        return rows.repartition(LANDED_PARTS, key) if sum(size for _, size, _ in files) < ROW_GROUP_BYTES else rows

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            layout = rollup.LAYOUT if name == ROLLUP else ()
            self._tables[name] = self.folder.write(name, self.plan(name), layout)
        return self._tables[name]
