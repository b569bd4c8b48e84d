"""Keys holding a third of all rows: joins are split, results stay whole."""

import pytest
from pyspark.sql import functions as F

from fieldfit.operators.esn import esn_validation
from fieldfit.operators.relational import drop_in, keep_in, not_in, sparse_left_join
from fieldfit.plans.completeness import with_company_totals
from fieldfit.operators.shipments import dedupe_shipments, installs_by_deal, serial_service, shipments

SPLIT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
}


@pytest.fixture()
def splitting(spark):
    """Adaptive execution that treats already small partitions as skewed."""
    for key, value in SPLIT_CONF.items():
        spark.conf.set(key, value)
    yield
    for key in SPLIT_CONF:
        spark.conf.unset(key)


def hot(col, prefix, share=3):
    """Every third row has key 0."""
    return F.concat(F.lit(prefix), F.when(col % share == 0, 0).otherwise(col).cast("string"))


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_ticket_is_split_and_counted_whole(spark, splitting, rows):
    n = 6000
    ids = spark.range(0, n, 1, 8)
    deliveries = ids.select(
        hot(F.col("id"), "T").alias("ticket_id_crm"),
        F.col("id").cast("string").alias("esn"),
        F.lit("u").alias("unit_id"),
        F.lit("DEV").alias("sku"),
    )
    tickets = ids.select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("ticket_id"),
        F.concat(F.lit("d"), F.col("id").cast("string")).alias("ticket_associated_deal_id"),
        F.lit("Envios").alias("pipeline_label"),
        F.lit("ok").alias("ticket_status"),
        F.lit("Upsell").alias("envio__classe"),
    )
    services = ids.select(
        F.col("id").cast("string").alias("esn"),
        F.lit("u").alias("unit_id"),
        F.expr("date_add(date'2024-01-01', int(id % 50))").alias("data_servico"),
        F.lit(True).alias("has_order"),
    )
    sent = shipments(tickets, deliveries)
    assert "skew=true" in final_plan(sent)
    per_deal = installs_by_deal(serial_service(dedupe_shipments(sent), services))
    top = per_deal.orderBy(F.desc("qtd_enviada")).select("ticket_associated_deal_id", "qtd_enviada", F.size("service_days"))
    # Days, not serials, bound the list of the deal holding a third of all rows.
    assert tuple(top.first()) == ("d0", n // 3, 50)
    assert rows(per_deal.agg(F.sum("qtd_enviada"))) == [(n,)]


def test_hot_serial_of_expected_pairs(spark, splitting):
    n = 3000
    ids = spark.range(0, n, 1, 8)
    cube = ids.select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("ticket_id"),
        F.lit("c").alias("company_id"),
        F.lit("Serviços").alias("pipeline_label"),
        F.lit("Agendar instalação").alias("ticket_status"),
        F.array(hot(F.col("id"), "s")).alias("instalacao__esns_processados"),
    )
    deliveries = ids.select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("ticket_id_crm"),
        hot(F.col("id"), "s").alias("esn"),
        F.lit("m").alias("modelo_item"),
        F.lit("i").alias("item_name"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, int(id))").alias("created_at"),
    )
    out = esn_validation(cube, deliveries)
    assert "skew=true" in final_plan(out)
    assert out.count() == n and out.filter("esn_status = 'ok'").count() == n


def test_not_in_with_a_hot_probe_key(spark, splitting):
    n = 6000
    probe = spark.range(0, n, 1, 8).select(hot(F.col("id"), "d").alias("k"), F.col("id"))
    out = not_in(probe, spark.createDataFrame([("d1",), ("d2",)], "k string"), "k")
    assert out.count() == n - 2


def only_join(df, key: str) -> list[str]:
    """Joins of the final plan that name the key."""
    df.collect()
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line and key in line]


def hot_rows(spark, n=6000):
    return spark.range(0, n, 1, 8).select(hot(F.col("id"), "d").alias("k"), F.col("id"))


def test_semi_and_anti_joins_split_a_hot_probe_key(spark, splitting):
    n = 6000
    keys = spark.range(0, n, 1, 8).select(F.concat(F.lit("d"), (F.col("id") % 3000).cast("string")).alias("k"))
    known = sum((0 if i % 3 == 0 else i) < 3000 for i in range(n))
    for join, kept in ((keep_in, known), (drop_in, n - known)):
        out = join(hot_rows(spark), keys, "k")
        assert any("skew=true" in line for line in only_join(out, "k#")), join
        assert out.count() == kept


def test_not_in_splits_a_hot_probe_key(spark, splitting):
    sub = spark.range(1, 3000, 1, 8).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("k"))
    out = not_in(hot_rows(spark), sub, "k")
    assert any("skew=true" in line for line in only_join(out, "k#"))
    assert out.count() == len([i for i in range(6000) if not 1 <= (0 if i % 3 == 0 else i) < 3000])


def test_company_totals_split_a_hot_company(spark, splitting):
    metrics = spark.range(0, 6000, 1, 8).select(
        hot(F.col("id"), "c").alias("company_id"),
        F.xxhash64("id").alias("deal_id"),
        F.lit(True).alias("elegivel"),
        F.lit(2).alias("qtd_completude"),
        F.lit(1).alias("qtd_instalada"),
        F.lit(True).alias("dentro_do_prazo"),
    )
    out = with_company_totals(metrics)
    assert any("skew=true" in line for line in only_join(out, "company_id#"))
    assert out.filter("company_id = 'c0' and qtd_completude_empresa = 4000").count() == 2000


def test_expected_serials_split_at_a_hot_serial(spark, splitting):
    n = 6000
    cube = spark.range(0, n, 1, 8).select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("ticket_id"),
        F.lit("c").alias("company_id"),
        F.lit("Serviços").alias("pipeline_label"),
        F.lit("Agendar instalação").alias("ticket_status"),
        F.array(hot(F.col("id"), "s")).alias("instalacao__esns_processados"),
    )
    deliveries = spark.range(0, n, 1, 8).select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("ticket_id_crm"),
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("esn"),
        F.lit("m").alias("modelo_item"),
        F.lit("i").alias("item_name"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, int(id))").alias("created_at"),
    )
    out = esn_validation(cube, deliveries)
    assert any("skew=true" in line for line in only_join(out, "esn#"))
    assert out.count() == n


def test_null_probe_keys_are_spread(spark, splitting):
    left = spark.range(0, 6000, 1, 8).select(F.lit(None).cast("string").alias("k"), F.col("id"))
    right = spark.range(0, 600, 1, 8).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    out = sparse_left_join(left, right, "k", ["id"]).withColumn("task", F.spark_partition_id())
    assert out.select("task").distinct().count() > 1 and out.count() == 6000
