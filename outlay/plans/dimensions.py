"""The four dimensions, each from one staging table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.functions.dates import election_type, is_election_year, mandate_year
from outlay.functions.keys import surrogate_key
from outlay.operators.versions import representative


def dim_municipio(stg_convenios: DataFrame) -> DataFrame:
    """One row per municipality code; spellings differ, the smallest name wins."""
    named = stg_convenios.select(
        F.col("municipio_codigo_ibge").alias("codigo_ibge"),
        F.col("municipio_nome").alias("nome_municipio"),
        F.col("municipio_uf_sigla").alias("uf_sigla"),
        F.col("municipio_uf_nome").alias("uf_nome"),
        F.col("municipio_codigo_regiao").alias("codigo_regiao"),
        F.col("municipio_nome_regiao").alias("nome_regiao"),
    )
    one = representative(named, ["codigo_ibge"], ["nome_municipio"])
    return one.select(surrogate_key(F.col("codigo_ibge")).alias("sk_municipio"), "*")


def dim_orgao_superior(stg_convenios: DataFrame) -> DataFrame:
    """One row per top-level agency code."""
    named = stg_convenios.select(
        F.col("orgao_superior_codigo").alias("codigo_orgao_superior"),
        F.col("orgao_superior_nome").alias("nome_orgao_superior"),
        F.col("orgao_superior_sigla").alias("sigla_orgao_superior"),
    )
    one = representative(named, ["codigo_orgao_superior"], ["nome_orgao_superior"])
    return one.select(surrogate_key(F.col("codigo_orgao_superior")).alias("sk_orgao_superior"), "*")


def dim_autor_emenda(stg_emendas: DataFrame, individual_pattern: str = "%individual%") -> DataFrame:
    """One row per author and amendment type; a person under two types counts twice."""
    return (
        stg_emendas.select("nome_autor", "tipo_emenda")
        .distinct()
        .select(
            surrogate_key(F.col("nome_autor"), F.col("tipo_emenda")).alias("sk_autor_emenda"),
            "nome_autor",
            "tipo_emenda",
            F.col("tipo_emenda").ilike(individual_pattern).alias("eh_parlamentar_individual"),
        )
    )


def dim_ano_eleitoral(stg_emendas: DataFrame) -> DataFrame:
    """One row per year present in the data, with its place in the election cycle."""
    year = F.col("ano")
    return (
        stg_emendas.select("ano")
        .distinct()
        .select(
            "ano",
            is_election_year(year).alias("eh_ano_eleitoral"),
            election_type(year).alias("tipo_eleicao"),
            mandate_year(year).alias("posicao_mandato_federal"),
        )
    )
