"""Facts whose dimensions come from the same staging table are built without moving a row."""

import os

import pytest
from compare import TEST_DATA

from outlay.plans import dimensions, facts
from outlay.standin import LANDED_PARTS, Marts

SF_DIR = f"{TEST_DATA}/{os.environ.get('OUTLAY_SF', 'sf0.001')}"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def rows_of(frame):
    return sorted(map(str, frame.collect()))


AMENDMENT = "codigo_emenda string, numero_emenda string, ano int, tipo_emenda string, nome_autor string, " + (
    "localidade_gasto string, funcao string, subfuncao string, "
    + ", ".join(
        f"valor_{name} decimal(18,2)"
        for name in ("empenhado", "liquidado", "pago", "resto_inscrito", "resto_cancelado", "resto_pago")
    )
)


def test_computed_author_keys_are_those_of_the_dimension(spark):
    rows = [(str(i), "1", 2020, kind, name, *"lfs", *[None] * 6) for i, (kind, name) in enumerate([("a", "x|"), (None, "x"), ("", "y"), ("|a", "x")])]
    stg = spark.createDataFrame(rows, AMENDMENT)
    assert rows_of(facts.fct_emendas(stg)) == rows_of(facts.fct_emendas(stg, dimensions.dim_autor_emenda(stg)))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="provided tables are absent")
def test_marts_facts_do_not_move(spark):
    marts = Marts.of(spark, SF_DIR)
    for name in ("fct_convenios", "fct_emendas"):
        plan = plan_of(marts.plan(name))
        assert "Exchange" not in plan and "Join" not in plan
    joined = facts.fct_convenios(marts["stg_convenios"], marts["dim_municipio"], marts["dim_orgao_superior"])
    assert rows_of(joined) == rows_of(marts["fct_convenios"])
    assert rows_of(facts.fct_emendas(marts["stg_emendas"], marts["dim_autor_emenda"])) == rows_of(marts["fct_emendas"])


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="provided tables are absent")
def test_only_small_tables_are_dealt_anew(spark, monkeypatch):
    marts = Marts(spark, SF_DIR)
    dealt = f"{LANDED_PARTS}), REPARTITION_BY_NUM"
    assert dealt in plan_of(marts.plan("stg_emendas"))
    monkeypatch.setattr("outlay.standin.ROW_GROUP_BYTES", 0)
    assert "REPARTITION" not in plan_of(marts.plan("stg_emendas"))
    assert "REPARTITION" not in plan_of(marts.plan("stg_convenios"))
