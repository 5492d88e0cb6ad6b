"""Column contracts of the two sources, the raw tables and the data tests.

Fixed values: field names, column names and types are the published data
contract, so every backend and consumer sees the same tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = "decimal(18,2)"
MONEY_TOTAL = "decimal(38,2)"

# (path in the JSON document, column, type)
AGREEMENT_FIELDS = (
    ("id", "id_convenio", "bigint"),
    ("numeroProcesso", "numero_processo", "string"),
    ("situacao", "situacao", "string"),
    ("dataPublicacao", "data_publicacao", "date"),
    ("dataInicioVigencia", "data_inicio_vigencia", "date"),
    ("dataFinalVigencia", "data_final_vigencia", "date"),
    ("valor", "valor", MONEY),
    ("valorLiberado", "valor_liberado", MONEY),
    ("valorContrapartida", "valor_contrapartida", MONEY),
    ("municipioConvenente.codigoIBGE", "municipio_codigo_ibge", "string"),
    ("municipioConvenente.nomeIBGE", "municipio_nome", "string"),
    ("municipioConvenente.codigoRegiao", "municipio_codigo_regiao", "string"),
    ("municipioConvenente.nomeRegiao", "municipio_nome_regiao", "string"),
    ("municipioConvenente.uf.sigla", "municipio_uf_sigla", "string"),
    ("municipioConvenente.uf.nome", "municipio_uf_nome", "string"),
    ("orgao.codigoSIAFI", "orgao_codigo_siafi", "string"),
    ("orgao.nome", "orgao_nome", "string"),
    ("orgao.sigla", "orgao_sigla", "string"),
    ("orgao.orgaoMaximo.codigo", "orgao_superior_codigo", "string"),
    ("orgao.orgaoMaximo.nome", "orgao_superior_nome", "string"),
    ("orgao.orgaoMaximo.sigla", "orgao_superior_sigla", "string"),
)

# Type "brl" is money as Brazilian-format text.
AMENDMENT_FIELDS = (
    ("codigoEmenda", "codigo_emenda", "string"),
    ("numeroEmenda", "numero_emenda", "string"),
    ("ano", "ano", "int"),
    ("tipoEmenda", "tipo_emenda", "string"),
    ("nomeAutor", "nome_autor", "string"),
    ("localidadeDoGasto", "localidade_gasto", "string"),
    ("funcao", "funcao", "string"),
    ("subfuncao", "subfuncao", "string"),
    ("valorEmpenhado", "valor_empenhado", "brl"),
    ("valorLiquidado", "valor_liquidado", "brl"),
    ("valorPago", "valor_pago", "brl"),
    ("valorRestoInscrito", "valor_resto_inscrito", "brl"),
    ("valorRestoCancelado", "valor_resto_cancelado", "brl"),
    ("valorRestoPago", "valor_resto_pago", "brl"),
)

RAW_AGREEMENTS = T.StructType(
    [
        T.StructField("dado", T.StringType()),
        T.StructField("carregado_em", T.TimestampType()),
        T.StructField("janela_inicio", T.DateType()),
        T.StructField("janela_fim", T.DateType()),
    ]
)

RAW_AMENDMENTS = T.StructType(
    [
        T.StructField("dado", T.StringType()),
        T.StructField("carregado_em", T.TimestampType()),
        T.StructField("ano_snapshot", T.IntegerType()),
    ]
)


def document_schema(fields) -> T.StructType:
    """The nested document, to be parsed in ``FAILFAST`` mode.

    Leaves are text, so a malformed id or date fails in the later cast. Money
    numbers are read as decimals at once: as text they would pass through a
    double and lose cents above 15 digits.
    """
    tree: dict = {}
    for path, _, kind in fields:
        node = tree
        *parents, leaf = path.split(".")
        for parent in parents:
            node = node.setdefault(parent, {})
        node[leaf] = T.DecimalType(18, 2) if kind == MONEY else T.StringType()

    def struct(node: dict) -> T.StructType:
        return T.StructType(
            [
                T.StructField(name, struct(child) if isinstance(child, dict) else child)
                for name, child in node.items()
            ]
        )

    return struct(tree)
