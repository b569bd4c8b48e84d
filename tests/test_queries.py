"""Registered queries against their SQL, and the shape of their plans."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from fieldfit.bindings.registry import REGISTRY

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SPARK_TO_SQL = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no sample tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry_points.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_queries_read_whole_tables():
    for name in REGISTRY:
        sql = entry_points.oracle_sql()[name]
        assert not re.search(r"\bLIMIT\b|\bTABLESAMPLE\b|%\s*\d+\s*=", sql, re.IGNORECASE)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(name, spark, con):
    df = entry_points.queries()[name](spark, SF)
    result = con.execute(entry_points.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert {f.name: SPARK_TO_SQL[f.dataType.simpleString()] for f in df.schema.fields} == types
    names = list(types)
    theirs = sorted(repr(r) for r in result.fetchall())
    ours = sorted(repr(tuple(r)) for r in df.select(*names).collect())
    assert len(ours) == len(theirs)
    assert [pair for pair in zip(ours, theirs) if pair[0] != pair[1]][:2] == []


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


PLANNED = ["completeness_by_deal", "esn_validation", "dashboard_table", "upsert", "grade_evolution", "remove_stale", "ticket_products"]


@pytest.mark.parametrize("name", PLANNED)
def test_plan_is_built_in_expressions_and_equi_joins(name, spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(entry_points.queries()[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for bad in ("PythonUDF", "ArrowEval", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "FlatMapGroups"):
        assert bad not in text


def test_scan_is_pruned_and_filtered(spark, plan):
    text = plan(entry_points.queries()["esn_validation"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert all("l_extendedprice" not in s and "o_totalprice" not in s for s in schemas)
    assert "PushedFilters" in text


def test_ranking_is_cut_before_the_shuffle(spark, plan):
    for name in ("newest_delivery", "unique_shipments", "latest_note", "deduped_deals"):
        assert plan(entry_points.queries()[name](spark, SF)).count("WindowGroupLimit") >= 2
