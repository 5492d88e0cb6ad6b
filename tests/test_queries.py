"""Every registered query against its SQL on the provided tables."""

import os
import shutil

import pytest
from compare import TEST_DATA, differences, duck

import __spark_entry__ as entry_points
from outlay.catalog import QUERIES
from outlay.oracle import ORACLE as SQL
from outlay.standin import Marts

SF_DIR = f"{TEST_DATA}/{os.environ.get('OUTLAY_SF', 'sf0.001')}"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="provided tables are absent")


@pytest.fixture(scope="module")
def database():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    frame = QUERIES[name](spark, SF_DIR)
    cursor = database.execute(SQL[name])
    names = [column[0] for column in cursor.description]
    assert differences(frame.collect(), frame.columns, cursor.fetchall(), names) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["ranking_agencies", "municipalities", "ranking_authors", "kpis_amendments"])
def test_facts_are_summed_before_they_are_joined(spark, name):
    """Below every join the fact side is already one row per key."""
    lines = plan_of(QUERIES[name](spark, SF_DIR)).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    below = "\n".join(lines[join:])
    assert below.index("partial_sum") < below.index("FileScan")


@pytest.mark.parametrize("name", ["top20_filtered", "top15_authors", "authors_sorted", "dash_ranking"])
def test_top_rows_are_kept_without_a_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, SF_DIR))


def test_totals_scan_the_fact_twice(spark):
    plan = plan_of(QUERIES["kpis"](spark, SF_DIR))
    assert sum("FileScan" in line and "sk_municipio" in line or "valor:" in line for line in plan.splitlines()) <= 2


def test_dashboard_sums_before_it_joins_large_places(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("dash_ranking", "dash_series"):
            lines = plan_of(QUERIES[name](spark, SF_DIR)).splitlines()
            join = max(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "sk_municipio" in line)
            below = "\n".join(lines[join:])
            assert "partial_sum" in below and below.index("partial_sum") < below.index("FileScan")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_changed_table_is_seen(spark, tmp_path):
    folder = str(tmp_path / "tables")
    shutil.copytree(SF_DIR, folder)
    before = QUERIES["ranking_agencies"](spark, folder).groupBy().sum("numero_convenios").first()[0]
    half = spark.read.parquet(f"{SF_DIR}/orders.parquet").where("o_orderkey % 2 = 0").toPandas()
    os.chmod(f"{folder}/orders.parquet", 0o644)
    half.to_parquet(f"{folder}/orders.parquet", index=False, coerce_timestamps="us")
    after = QUERIES["ranking_agencies"](spark, folder).groupBy().sum("numero_convenios").first()[0]
    assert 0 < after < before


def test_large_dimensions_are_not_broadcast(spark):
    """Beyond the size limit the same queries run as sort-merge joins with equal rows."""
    marts = Marts.of(spark, SF_DIR)
    names = ["municipalities", "dash_ranking", "fct_agreements", "kpis_amendments"]
    expected = {name: sorted(QUERIES[name](spark, SF_DIR).collect(), key=str) for name in names}
    assert marts["dim_municipio"].count() > 0
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in names:
            frame = QUERIES[name](spark, SF_DIR)
            assert "BroadcastHashJoin" not in plan_of(frame) and "SortMergeJoin" in plan_of(frame)
            assert sorted(frame.collect(), key=str) == expected[name]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(QUERIES["ranking_agencies"](spark, SF_DIR))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "valor" in line)
    schema = scan[scan.index("ReadSchema"):]
    assert "sk_orgao_superior" in schema and "valor:" in schema and "numero_processo" not in schema
    assert "IsNotNull(sk_orgao_superior)" in scan
