"""Hand-written source records."""

from __future__ import annotations

import json

AS_OF = "2026-07-20"

PLACE = {
    "codigoIBGE": "5001102",
    "nomeIBGE": "AQUIDAUANA",
    "codigoRegiao": "CO",
    "nomeRegiao": "Centro-Oeste",
    "uf": {"sigla": "MS", "nome": "Mato Grosso do Sul"},
}
AGENCY = {
    "codigoSIAFI": "1",
    "nome": "Fundo",
    "sigla": "FN",
    "orgaoMaximo": {"codigo": "36000", "nome": "Ministério da Saúde", "sigla": "MS"},
}


def agreement(id_, **changes):
    record = {
        "id": id_,
        "numeroProcesso": f"P{id_}",
        "situacao": "ADIMPLENTE",
        "dataPublicacao": "2026-03-10",
        "dataInicioVigencia": "2026-03-10",
        "dataFinalVigencia": "2027-03-10",
        "valor": 100.00,
        "valorLiberado": 40.00,
        "valorContrapartida": 1.50,
        "municipioConvenente": dict(PLACE),
        "orgao": dict(AGENCY),
    }
    record.update(changes)
    return record


def amendment(code, **changes):
    record = {
        "codigoEmenda": code,
        "numeroEmenda": "0001",
        "ano": 2024,
        "tipoEmenda": "Emenda Individual - Transferências Especiais",
        "nomeAutor": "FULANO",
        "localidadeDoGasto": "NACIONAL",
        "funcao": "Saúde",
        "subfuncao": "Atenção básica",
        "valorEmpenhado": "1.000,00",
        "valorLiquidado": "500,00",
        "valorPago": "250,00",
        "valorRestoInscrito": "0,00",
        "valorRestoCancelado": "- 721,68",
        "valorRestoPago": "",
    }
    record.update(changes)
    return record


def lines(records):
    return [json.dumps(record, ensure_ascii=False) for record in records]


def documents(spark, records):
    return spark.createDataFrame([(line,) for line in lines(records)], "dado string")


def raw_agreements(spark, loads):
    """``loads`` maps a load time to its records."""
    rows = [(line, stamp, None, None) for stamp, records in loads.items() for line in lines(records)]
    frame = spark.createDataFrame(rows, "dado string, t string, a string, b string")
    return frame.selectExpr(
        "dado", "cast(t as timestamp) carregado_em", "cast(a as date) janela_inicio", "cast(b as date) janela_fim"
    )
