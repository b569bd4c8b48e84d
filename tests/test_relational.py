import datetime as dt

from pyspark.sql import functions as F

import pytest

from fieldfit.operators import relational as r


def test_membership_filters_follow_sql_null_rules(frame, rows):
    df = frame("k string", ("a",), ("b",), (None,))
    assert rows(r.where_in(df, "k", ["a"])) == [("a",)]
    assert rows(r.where_not_in(df, "k", ["a"])) == [("b",)]
    assert rows(r.where_not_prefixed(df, "k", ["a", "x"])) == [("b",)]


def test_drop_denied_takes_literals_or_a_table(frame, rows):
    df = frame("deal string", ("1",), ("2",), (None,))
    assert rows(r.drop_denied(df, "deal", ("1",))) == [("2",)]
    assert rows(r.drop_denied(df, "deal", frame("id string", ("1",)))) == [("2",)]
    assert r.drop_denied(df, "deal", ()).count() == 3


def test_not_in_null_cases(frame, rows):
    df = frame("k string, v int", ("a", 1), ("b", 2), (None, 3))
    assert rows(r.not_in(df, frame("k string", ("a",), ("a",)), "k"), "k") == [("b",)]
    assert r.not_in(df, frame("k string", ("a",), (None,)), "k").count() == 0
    assert r.not_in(df, frame("k string", ("a",)).limit(0), "k").count() == 3


def test_not_in_equals_the_sql_form(frame, rows):
    df = frame("k string", *[(str(i),) for i in range(30)], (None,))
    for sub in (frame("k string", ("3",), ("7",)), frame("k string", (None,)), frame("k string", ("x",)).limit(0)):
        df.createOrReplaceTempView("probe")
        sub.createOrReplaceTempView("sub")
        expected = df.sparkSession.sql("select k from probe where k not in (select k from sub)")
        assert rows(r.not_in(df, sub, "k")) == rows(expected)


def test_semi_and_anti_join_ignore_duplicates(frame, rows):
    df = frame("k string", ("a",), ("b",), (None,))
    keys = frame("k string", ("a",), ("a",), (None,))
    assert rows(r.keep_in(df, keys, "k")) == [("a",)]
    assert rows(r.drop_in(df, keys, "k")) == [("b",), (None,)]


def test_latest_per_key_uses_ties(frame, rows):
    df = frame("k string, t int, u string", ("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "w"))
    out = r.latest_per_key(df, ["k"], [F.desc("t")], [F.desc("u")])
    assert rows(out) == [("a", 2, "z"), ("b", None, "w")]


def test_latest_per_key_ranks_before_the_shuffle(frame, plan):
    df = frame("k string, t int", ("a", 1))
    assert plan(r.latest_per_key(df, ["k"], [F.desc("t")])).count("WindowGroupLimit") >= 2


def test_sparse_left_join_equals_left_join_and_spreads_nulls(spark, rows, plan):
    left = spark.range(400).select(
        F.col("id"), F.when(F.col("id") < 300, None).otherwise((F.col("id") % 5).cast("string")).alias("k")
    )
    right = spark.createDataFrame([("0", "zero"), ("3", "three"), (None, "null")], "k string, name string")
    out = r.sparse_left_join(left, right, "k", ["id"])
    assert rows(out, "id", "k", "name") == rows(left.join(right, "k", "left"), "id", "k", "name")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(r.sparse_left_join(left, right, "k", ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_spread" in text.split("SortMergeJoin")[1] or "hashpartitioning(k" in text
    assert any("hashpartitioning" in line and "_spread" in line for line in text.splitlines())


def test_wide_to_long_drops_zero_null_and_excluded(frame, rows):
    df = frame(
        "id string, quantidade_instalacao_a string, quantidade_instalacao_b string, quantidade_instalacao_calculado_c string",
        ("t1", "2", "0", "9"),
        ("t2", None, "3", "9"),
        ("t3", "", " ", "9"),
    )
    cols = r.pick_columns(df, "quantidade_instalacao_", "calculado")
    assert cols == ["quantidade_instalacao_a", "quantidade_instalacao_b"]
    out = r.wide_to_long(df, ["id"], cols)
    assert rows(out) == [("t1", "quantidade_instalacao_a", 2), ("t2", "quantidade_instalacao_b", 3)]
    for wrong in ("x", "0.5"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT|no whole number"):
            r.wide_to_long(frame("id string, quantidade_a string", ("t", wrong)), ["id"], ["quantidade_a"]).collect()


def test_explode_items_and_guard(frame, rows):
    df = frame("t string, a array<string>", ("x", ["1", "2"]), ("y", []), ("z", None))
    assert rows(r.has_items(df, "a"), "t") == [("x",)]
    assert rows(r.explode_items(df, "a", "esn")) == [("x", "1"), ("x", "2")]


def test_search_signed_since_and_scope(frame, rows):
    df = frame("a string, b string", ("Foo", None), (None, "xfOo"), ("bar", None))
    assert r.search(df, "foo", ["a", "b"]).count() == 2
    dated = frame("d date", (dt.date(2024, 1, 1),), (dt.date(2023, 12, 31),), (None,))
    assert rows(r.signed_since(dated, dt.date(2024, 1, 1), "d")) == [(dt.date(2024, 1, 1),)]
    cube = frame("pipeline_label string, ticket_status string", ("P", "x"), ("P", "y"), ("Q", "x"))
    assert r.in_scope(cube, "P").count() == 2 and r.in_scope(cube, "P", "x").count() == 1
