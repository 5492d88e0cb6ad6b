"""A rollup of the agreement fact over the dashboard's filters, rebuilt with the marts.

Region, state and municipality are levels of one hierarchy of names. For each
level the rollup holds the totals of its places, those by agency and those by
month, so a dashboard query reads the rows of one level and never the fact. A
query takes the coarsest level that names all its filters and adds the rows
that pass them: places of one level do not overlap, so sums, counts and the
number of places add up exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.operators.filters import optional_equals
from outlay.operators.ranking import top_n
from outlay.plans.dashboard import SCOPE_COLUMNS, TOP_AGENCIES
from outlay.plans.products import count_rows, total

#: Names from the widest to the narrowest place; level n names the first n of them.
PLACE = tuple(SCOPE_COLUMNS.values())
LAYOUT = ("assunto", "nivel")
KPIS, AGENCY, MONTH = "kpis", "orgao", "mes"


def scope_rollup(fct_convenios: DataFrame, dim_orgao_superior: DataFrame, dim_municipio: DataFrame) -> DataFrame:
    """``assunto, nivel``, the names of the place, ``orgao``, ``mes``, ``valor, liberado, n, lugares``.

    Facts are summed per place before they are joined; then the rows are as many as places times
    agencies and months, whatever the fact. Those by agency and those by month come from one such sum, one join and
    one grouping, so they move together. Facts whose place or agency is unknown are left out, as in the dashboard.
    """
    places = dim_municipio.select("sk_municipio", *PLACE)

    def sums(keys: list[str], named: Callable[[DataFrame], DataFrame], subjects: dict[str, tuple[str, ...]]) -> DataFrame:
        per_place = fct_convenios.groupBy("sk_municipio", *keys).agg(
            total("valor").alias("valor"), total("valor_liberado").alias("liberado"), count_rows().alias("n")
        )
        rows = named(per_place).join(places, "sk_municipio")
        every = [name for by in subjects.values() for name in by]
        # Names may be null themselves, so subject and level come from the grouping and not from the names.
        sets = [[*PLACE[:level], *by] for by in subjects.values() for level in range(len(PLACE) + 1)]
        measures = [
            F.grouping_id().alias("_grouping"),
            total("valor").alias("valor"),
            total("liberado").alias("liberado"),
            F.sum("n").alias("n"),
            (F.lit(None).cast("long") if every else count_rows()).alias("lugares"),
        ]
        grouped = rows.groupingSets(sets, *PLACE, *every).agg(*measures)
        left_out = F.col("_grouping").bitwiseAND((1 << len(every)) - 1)
        unnamed = F.bit_count(F.shiftright(F.col("_grouping"), len(every)))
        subject = F.coalesce(
            *[
                F.when(left_out == sum(1 << i for i, name in enumerate(reversed(every)) if name not in by), F.lit(subject))
                for subject, by in subjects.items()
            ]
        )
        return grouped.select(
            subject.alias("assunto"),
            (len(PLACE) - unnamed).cast("int").alias("nivel"),
            *PLACE,
            (F.col("orgao") if "orgao" in every else F.lit(None).cast("string")).alias("orgao"),
            (F.col("mes") if "mes" in every else F.lit(None).cast("date")).alias("mes"),
            "valor",
            "liberado",
            "n",
            "lugares",
            *[name for name in every if name not in ("orgao", "mes")],
        )

    agencies = dim_orgao_superior.select(
        "sk_orgao_superior", F.col("nome_orgao_superior").alias("orgao"), F.lit(True).alias("_known")
    )
    by_agency_and_month = sums(
        ["sk_orgao_superior", "mes_referencia"],
        lambda rows: rows.join(agencies, "sk_orgao_superior", "left").withColumnRenamed("mes_referencia", "mes"),
        {AGENCY: ("orgao", "_known"), MONTH: ("mes",)},
    )
    known = F.when(F.col("assunto") == AGENCY, F.col("_known").isNotNull()).otherwise(F.col("mes").isNotNull())
    return sums([], lambda rows: rows, {KPIS: ()}).unionByName(by_agency_and_month.where(known).drop("_known"))


def in_scope(rollup: DataFrame, subject: str, filters: dict[str, str | None]) -> DataFrame:
    """The rows of a subject that pass the filters, from the coarsest level that names them."""
    chosen = {SCOPE_COLUMNS[marker]: value for marker, value in filters.items()}
    level = max([PLACE.index(column) + 1 for column, value in chosen.items() if value], default=0)
    rows = rollup.where((F.col("assunto") == subject) & (F.col("nivel") == level))
    return optional_equals(rows, chosen)


def _number(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def rollup_kpis(rollup: DataFrame, **filters: str | None) -> DataFrame:
    return in_scope(rollup, KPIS, filters).agg(
        total("valor").alias("valor_total"),
        total("liberado").alias("valor_liberado"),
        _number("n").alias("numero_convenios"),
        _number("lugares").alias("numero_municipios"),
    )


def rollup_ranking(rollup: DataFrame, n: int = TOP_AGENCIES, **filters: str | None) -> DataFrame:
    sums = in_scope(rollup, AGENCY, filters).groupBy("orgao").agg(
        total("valor").alias("valor_total"), F.sum("n").alias("numero_convenios")
    )
    return top_n(sums, "valor_total", ["orgao"], n)


def rollup_serie(rollup: DataFrame, **filters: str | None) -> DataFrame:
    return (
        in_scope(rollup, MONTH, filters)
        .groupBy("mes")
        .agg(total("valor").alias("valor_total"), F.sum("n").alias("numero_convenios"))
        .orderBy("mes")
    )
