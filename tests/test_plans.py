"""Plans: bucketed joins without a shuffle, one scan of the lines, two reads of the values."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldfit.bindings import queries as q
from fieldfit.bindings.sample import AS_OF, RULES, Sample
from fieldfit.operators import contracts
from fieldfit.plans import completeness, dashboard
from fieldfit.sources import write_bucketed

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ticket_keyed_sides_of_the_dashboard_are_not_shuffled(spark, no_broadcast):
    s = Sample(spark, SF)
    tickets, field, pairs, notes = (s.kept(n, "ticket_id") for n in ("tickets_sync", "field", "pairs", "notes"))
    visits = dashboard.field_main(field).select("ticket_id", "status")
    joined = tickets.join(visits, "ticket_id", "left").join(dashboard.esn_by_ticket(pairs), "ticket_id", "left").join(dashboard.latest_note(notes), "ticket_id", "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan
    whole = q.dash(s)._jdf.queryExecution().executedPlan().toString()
    assert whole.count("SelectedBucketsCount") == 4


def test_bucketed_table_round_trip(spark, rows, tmp_path):
    df = spark.range(100).select((F.col("id") % 30).alias("k"), "id").unionByName(spark.createDataFrame([(None, -1)], "k bigint, id bigint"))
    back = write_bucketed(df, "t_bucketed", "k", str(tmp_path / "t"), 5)
    assert rows(back) == rows(df)
    assert back.count() == 101 and len(list((tmp_path / "t").glob("part-*"))) <= 5


def test_compact_lines_give_the_same_facts(spark, rows):
    lines = Sample(spark, SF).kept("lines")
    small = contracts.compact_lines(lines, RULES)
    assert small.count() < lines.count()
    for made in (lambda x: contracts.contract_grain(x, RULES), lambda x: contracts.downgraded_deals(x, RULES), contracts.last_churn, contracts.first_sale):
        assert rows(made(small)) == rows(made(lines))


def test_completeness_plan_is_short(spark, no_broadcast):
    s = Sample(spark, SF)
    plan = completeness.completeness_by_deal(s.warehouse(), AS_OF, RULES)._jdf.queryExecution().executedPlan().toString()
    count = Counter(re.findall(r"(?<!Reused)Exchange|Scan parquet", plan))
    assert count["Exchange"] <= 20, count
    assert "lines-" not in plan.replace("contract-lines-", "")  # the lines themselves are read once, before


def test_percentiles_read_their_input_twice(spark):
    """By an accumulator in the input: every pass over it adds its rows once."""
    seen = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(0, 3000, 1, 4).select((F.col("id") * 37 % 1000).cast("double").alias("mrr")).mapInArrow(passing, "mrr double")
    got = {r.p: r.value for r in dashboard.mrr_thresholds(df).collect()}
    assert seen.value == 2 * 3000
    assert got == pytest.approx({0.5: 499.5, 0.75: 749.25, 0.9: 899.1}, abs=0.5)
