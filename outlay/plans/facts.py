"""The two facts.

A dimension made from the same staging table has the key of every row, and a
surrogate key is a hash of that key: the fact computes it and does not move.
A dimension given from elsewhere is joined, without hints: a key it lacks must
show up as a null foreign key, and Spark broadcasts it only when the size of
its files allows it (else the join is a sort-merge join whose frequent keys are
split at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.functions.dates import month_start
from outlay.functions.keys import surrogate_key
from outlay.functions.money import safe_ratio


def fct_convenios(
    stg_convenios: DataFrame, dim_municipio: DataFrame | None = None, dim_orgao_superior: DataFrame | None = None
) -> DataFrame:
    """Without dimensions: of those made from ``stg_convenios``."""
    if dim_municipio is None:
        placed = stg_convenios.withColumn("sk_municipio", surrogate_key(F.col("municipio_codigo_ibge")))
    else:
        municipality = dim_municipio.select("sk_municipio", F.col("codigo_ibge").alias("municipio_codigo_ibge"))
        placed = stg_convenios.join(municipality, "municipio_codigo_ibge", "left")
    if dim_orgao_superior is None:
        named = placed.withColumn("sk_orgao_superior", surrogate_key(F.col("orgao_superior_codigo")))
    else:
        agency = dim_orgao_superior.select(
            "sk_orgao_superior", F.col("codigo_orgao_superior").alias("orgao_superior_codigo")
        )
        named = placed.join(agency, "orgao_superior_codigo", "left")
    return named.select(
        "id_convenio",
        "numero_processo",
        "situacao",
        "data_publicacao",
        "data_inicio_vigencia",
        "data_final_vigencia",
        month_start(F.col("data_publicacao")).alias("mes_referencia"),
        "sk_municipio",
        "sk_orgao_superior",
        "valor",
        "valor_liberado",
        "valor_contrapartida",
    )


def fct_emendas(stg_emendas: DataFrame, dim_autor_emenda: DataFrame | None = None) -> DataFrame:
    """Without a dimension: of the one made from ``stg_emendas``."""
    if dim_autor_emenda is None:
        named = stg_emendas.withColumn("sk_autor_emenda", surrogate_key(F.col("nome_autor"), F.col("tipo_emenda")))
    else:
        author = dim_autor_emenda.select("sk_autor_emenda", "nome_autor", "tipo_emenda")
        named = stg_emendas.join(author, ["nome_autor", "tipo_emenda"], "left")
    return named.select(
        "codigo_emenda",
        "numero_emenda",
        "ano",
        "localidade_gasto",
        "funcao",
        "subfuncao",
        "sk_autor_emenda",
        "valor_empenhado",
        "valor_liquidado",
        "valor_pago",
        "valor_resto_inscrito",
        "valor_resto_cancelado",
        "valor_resto_pago",
        safe_ratio(F.col("valor_pago"), F.col("valor_empenhado")).alias("taxa_execucao"),
    )
