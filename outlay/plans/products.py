"""The seven published data products.

Measures are first summed per foreign key, which combines on the map side, and
only then joined: the fact itself never takes part in a join, so neither a
frequent key nor a large dimension makes it move. A surrogate key occurs once
in its dimension, hence nothing is counted twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.functions.dates import month_label
from outlay.functions.money import safe_ratio
from outlay.operators.ranking import ranking
from outlay.schemas import MONEY_TOTAL


def total(column: str) -> Column:
    return F.sum(column).cast(MONEY_TOTAL)


def count_rows() -> Column:
    return F.count(F.lit(1))


def _count_total(column: str) -> Column:
    """Sum of partial counts; 0 where there was nothing to count."""
    return F.coalesce(F.sum(column), F.lit(0))


def kpis(fct_convenios: DataFrame, dim_orgao_superior: DataFrame) -> DataFrame:
    """One row, also for an empty fact: sums, dates and objects null, counts 0."""
    by_agency_month = fct_convenios.groupBy("sk_orgao_superior", "mes_referencia").agg(
        total("valor").alias("valor"),
        total("valor_liberado").alias("liberado"),
        count_rows().alias("n"),
        F.min("data_publicacao").alias("inicio"),
        F.max("data_publicacao").alias("fim"),
    )
    names = dim_orgao_superior.select(
        "sk_orgao_superior", F.col("nome_orgao_superior").alias("nome"), F.lit(True).alias("achado")
    )
    # From here on there are a few rows per agency and month. Two agency codes
    # may share a name, and the top is asked by name.
    level = F.grouping_id()
    sums = (
        by_agency_month.join(names, "sk_orgao_superior", "left")
        .groupingSets(
            [["sk_orgao_superior"], ["nome", "achado"], ["mes_referencia"], []],
            "sk_orgao_superior", "nome", "achado", "mes_referencia",
        )
        .agg(
            level.alias("nivel"),
            total("valor").alias("valor"),
            total("liberado").alias("liberado"),
            _count_total("n").alias("n"),
            F.min("inicio").alias("inicio"),
            F.max("fim").alias("fim"),
        )
    )
    all_rows, by_agency, by_name, by_month = (F.col("nivel") == code for code in (0b1111, 0b0111, 0b1001, 0b1110))

    def first(of: Column, key: str) -> Column:
        """The row of largest value, then of smallest key; nulls last."""
        order = F.struct(F.col("valor").isNull(), -F.col("valor"), F.col(key).isNull(), F.col(key))
        return F.min_by(F.struct(F.col(key), F.col("valor")), F.when(of, order))

    municipalities = fct_convenios.agg(F.count_distinct("sk_municipio").alias("n"))
    totals = sums.agg(
        F.max(F.when(all_rows, F.col("valor"))).alias("total_valor"),
        F.max(F.when(all_rows, F.col("liberado"))).alias("total_valor_liberado"),
        F.coalesce(F.max(F.when(all_rows, F.col("n"))), F.lit(0).cast("long")).alias("numero_convenios"),
        F.count(F.when(by_agency, F.col("sk_orgao_superior"))).alias("numero_orgaos"),
        F.max(F.when(all_rows, F.col("inicio"))).alias("periodo_inicio"),
        F.max(F.when(all_rows, F.col("fim"))).alias("periodo_fim"),
        first(by_name & F.col("achado"), "nome").alias("top"),
        first(by_month, "mes_referencia").alias("pico"),
    )
    peak = F.struct(month_label(F.col("pico.mes_referencia")).alias("mes"), F.col("pico.valor").alias("valor"))
    return totals.select(
        "total_valor",
        "total_valor_liberado",
        "numero_convenios",
        municipalities.scalar().alias("numero_municipios"),
        "numero_orgaos",
        "periodo_inicio",
        "periodo_fim",
        F.col("top").alias("orgao_maior_gasto"),
        F.when(F.col("pico").isNotNull(), peak).alias("mes_pico"),
    )


def ranking_orgaos(fct_convenios: DataFrame, dim_orgao_superior: DataFrame) -> DataFrame:
    sums = fct_convenios.groupBy("sk_orgao_superior").agg(
        total("valor").alias("valor_total"), count_rows().alias("numero_convenios")
    )
    named = sums.join(dim_orgao_superior, "sk_orgao_superior").select(
        F.col("codigo_orgao_superior").alias("codigo"),
        F.col("nome_orgao_superior").alias("nome"),
        F.col("sigla_orgao_superior").alias("sigla"),
        "valor_total",
        "numero_convenios",
    )
    return ranking(named, "valor_total", ["codigo"])


def serie_temporal(fct_convenios: DataFrame) -> DataFrame:
    return (
        fct_convenios.where(F.col("mes_referencia").isNotNull())
        .groupBy("mes_referencia")
        .agg(total("valor").alias("valor_total"), count_rows().alias("numero_convenios"))
        .orderBy("mes_referencia")
        .select(month_label(F.col("mes_referencia")).alias("mes"), "valor_total", "numero_convenios")
    )


def municipios(fct_convenios: DataFrame, dim_municipio: DataFrame) -> DataFrame:
    sums = fct_convenios.groupBy("sk_municipio").agg(
        total("valor").alias("valor_total"), count_rows().alias("numero_convenios")
    )
    named = sums.join(dim_municipio, "sk_municipio").select(
        "codigo_ibge",
        F.col("nome_municipio").alias("nome"),
        "uf_sigla",
        "uf_nome",
        F.col("nome_regiao").alias("regiao"),
        "valor_total",
        "numero_convenios",
    )
    return ranking(named, "valor_total", ["codigo_ibge"])


AMENDMENT_TOTALS = ("valor_empenhado", "valor_pago", "valor_resto_cancelado")


def _amendment_sums(fct_emendas: DataFrame, key: str) -> DataFrame:
    return fct_emendas.groupBy(key).agg(
        *[total(name).alias(name) for name in AMENDMENT_TOTALS], count_rows().alias("numero_emendas")
    )


def kpis_emendas(fct_emendas: DataFrame, dim_autor_emenda: DataFrame) -> DataFrame:
    by_author = fct_emendas.groupBy("sk_autor_emenda").agg(
        *[total(name).alias(name) for name in AMENDMENT_TOTALS],
        count_rows().alias("n"),
        F.min("ano").alias("ano_inicio"),
        F.max("ano").alias("ano_fim"),
    )
    # One row per author by now: counting rows counts distinct authors.
    return by_author.join(dim_autor_emenda, "sk_autor_emenda").agg(
        total("valor_empenhado").alias("total_empenhado"),
        total("valor_pago").alias("total_pago"),
        total("valor_resto_cancelado").alias("total_cancelado"),
        safe_ratio(F.sum("valor_pago"), F.sum("valor_empenhado")).alias("taxa_execucao_geral"),
        _count_total("n").alias("numero_emendas"),
        F.count_if("eh_parlamentar_individual").alias("numero_parlamentares_individuais"),
        F.min("ano_inicio").alias("ano_inicio"),
        F.max("ano_fim").alias("ano_fim"),
    )


def ranking_parlamentares(fct_emendas: DataFrame, dim_autor_emenda: DataFrame) -> DataFrame:
    """The rate is the ratio of the sums: a mean of rates would weigh all amendments alike."""
    named = _amendment_sums(fct_emendas, "sk_autor_emenda").join(dim_autor_emenda, "sk_autor_emenda").select(
        F.col("nome_autor").alias("nome"),
        "tipo_emenda",
        F.col("eh_parlamentar_individual").alias("individual"),
        *AMENDMENT_TOTALS,
        safe_ratio(F.col("valor_pago"), F.col("valor_empenhado")).alias("taxa_execucao"),
        "numero_emendas",
    )
    return ranking(named, "valor_empenhado", ["nome", "tipo_emenda"])


def emendas_por_ano(fct_emendas: DataFrame, dim_ano_eleitoral: DataFrame) -> DataFrame:
    return (
        _amendment_sums(fct_emendas, "ano")
        .join(dim_ano_eleitoral, "ano")
        .select(
            "ano",
            "eh_ano_eleitoral",
            "tipo_eleicao",
            "posicao_mandato_federal",
            *AMENDMENT_TOTALS,
            safe_ratio(F.col("valor_pago"), F.col("valor_empenhado")).alias("taxa_execucao"),
            "numero_emendas",
        )
        .orderBy("ano")
    )
