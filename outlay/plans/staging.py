"""Raw documents to flat typed tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.functions.dates import recency_bound
from outlay.functions.money import brl_decimal
from outlay.operators.versions import latest_version
from outlay.schemas import AGREEMENT_FIELDS, AMENDMENT_FIELDS, document_schema


def flatten(fields) -> list[Column]:
    """The flat, renamed and typed columns of a nested document."""
    return [
        (brl_decimal(F.col(path)) if kind == "brl" else F.col(path).cast(kind)).alias(name)
        for path, name, kind in fields
    ]


def parse_documents(raw: DataFrame, fields, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse ``dado`` once and flatten it; ``keep`` lists raw columns to carry along.

    The parse is a generator of one row. Filters on parsed columns stay above a
    generator; through a plain projection they would be pushed down together
    with a copy of the whole parse for every column they mention.
    """
    document = F.from_json("dado", document_schema(fields), {"mode": "FAILFAST"})
    return raw.select(F.inline(F.array(document)), *keep).select(*flatten(fields), *keep)


def current_agreements(typed: DataFrame, as_of: date | str, keep_years: int = 3) -> DataFrame:
    """Newest version of each agreement, if complete and recently published.

    The version is chosen before the filters: an agreement whose newest version
    lost its municipality is gone, even when an older version had one.
    """
    current = latest_version(typed, ["id_convenio"], version_columns(typed))
    return complete_and_recent(current, as_of, keep_years).drop("janela_inicio", "janela_fim")


def version_columns(typed: DataFrame) -> list[str]:
    """What makes one version of an agreement newer than another, most significant first."""
    return [name for name in ("carregado_em", "janela_fim", "janela_inicio") if name in typed.columns]


def complete_and_recent(current: DataFrame, as_of: date | str, keep_years: int = 3) -> DataFrame:
    """The newest versions that name a municipality and an agency and were published recently."""
    return current.where(
        F.col("municipio_codigo_ibge").isNotNull()
        & F.col("orgao_superior_codigo").isNotNull()
        & (F.col("data_publicacao") >= recency_bound(as_of, keep_years))
    )


def complete_amendments(typed: DataFrame) -> DataFrame:
    return typed.where(F.col("nome_autor").isNotNull() & F.col("valor_empenhado").isNotNull())


def stg_convenios(raw: DataFrame, as_of: date | str) -> DataFrame:
    keep = tuple(name for name in ("carregado_em", "janela_inicio", "janela_fim") if name in raw.columns)
    return current_agreements(parse_documents(raw, AGREEMENT_FIELDS, keep), as_of)


def stg_emendas(raw: DataFrame) -> DataFrame:
    return complete_amendments(parse_documents(raw, AMENDMENT_FIELDS))


def stg_convenios_from_files(nested: DataFrame, as_of: date | str, loaded_at: str) -> DataFrame:
    """Staging of one landed snapshot, which has no load history of its own."""
    typed = nested.select(*flatten(AGREEMENT_FIELDS), F.lit(loaded_at).cast("timestamp").alias("carregado_em"))
    return current_agreements(typed, as_of)


def stg_emendas_from_files(nested: DataFrame) -> DataFrame:
    return complete_amendments(nested.select(*flatten(AMENDMENT_FIELDS)))
