"""Shipped serials, their first installation, and scheduled devices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldfit.config import (
    ACCESSORY_SKU_PREFIXES,
    ACCESSORY_SKUS,
    DEAD_SHIPMENT_STATUS,
    SCHEDULED_STATUS,
    SERVICE_PIPELINE,
    SHIPMENT_CLASSES,
    SHIPMENT_PIPELINE,
)
from fieldfit.functions import install_status
from fieldfit.operators.contracts import DEAL, START
from fieldfit.operators.relational import (
    distinct_keys,
    in_scope,
    keep_in,
    latest_per_key,
    positive,
    where_in,
    where_not_in,
    where_not_prefixed,
)


def shipments(tickets: DataFrame, deliveries: DataFrame, deals: DataFrame | None = None) -> DataFrame:
    """Delivered serials of live shipment tickets, accessories excluded.

    ``deals`` keeps only their shipments: the tickets are cut down to them, before
    these meet the deliveries.
    """
    sent = where_in(in_scope(tickets, SHIPMENT_PIPELINE), "envio__classe", SHIPMENT_CLASSES)
    sent = where_not_in(sent, "ticket_status", DEAD_SHIPMENT_STATUS)
    if deals is not None:
        sent = keep_in(sent, deals, DEAL)
    items = deliveries.filter(F.col("esn").isNotNull())
    items = where_not_in(where_not_prefixed(items, "sku", ACCESSORY_SKU_PREFIXES), "sku", ACCESSORY_SKUS)
    return sent.select("ticket_id", DEAL, "envio__classe").join(
        items.select(F.col("ticket_id_crm").alias("ticket_id"), "esn", "unit_id"), "ticket_id"
    ).select(DEAL, "esn", "unit_id", "envio__classe")


def dedupe_shipments(ships: DataFrame) -> DataFrame:
    """One row per (deal, serial): smallest class, then smallest unit."""
    return latest_per_key(ships, [DEAL, "esn"], [F.asc("envio__classe")], [F.asc("unit_id")])


def device_service(devices: DataFrame, finished: DataFrame) -> DataFrame:
    """Per device (serial, unit) with a service order: its first service date.

    A device without an order adds nothing, so NULL orders never reach the
    join; orders are reduced to their first date before it.
    """
    orders = finished.groupBy("ordem_de_servico").agg(F.min("data_servico").alias("data_servico"))
    return (
        devices.filter(F.col("ordem_de_servico").isNotNull())
        .join(orders, "ordem_de_servico", "left")
        .groupBy("esn", "unit_id")
        .agg(F.min("data_servico").alias("data_servico"))
        .withColumn("has_order", F.lit(True))
    )


def serial_service(unique_ships: DataFrame, services: DataFrame) -> DataFrame:
    """Unique shipments with the service facts of their device."""
    return unique_ships.join(services, ["esn", "unit_id"], "left").withColumn(
        "has_order", F.coalesce("has_order", F.lit(False))
    )


def first_installation(serials: DataFrame, contract_rows: DataFrame) -> DataFrame:
    """Install status per (deal, start, serial).

    A deal with several start dates is judged against each of them, instead of
    against an arbitrary one.
    """
    starts = distinct_keys(contract_rows, DEAL, START)
    status = install_status(F.col("data_servico"), F.col("has_order"), F.col(START))
    return serials.join(starts, DEAL).select(
        DEAL, START, "esn", "envio__classe", "data_servico", status.alias("status_instalacao")
    )


def installs_by_deal(serials: DataFrame) -> DataFrame:
    """Per deal: shipped serials, undated installs, and serials per service day.

    Counting per (deal, day) first leaves at most one row per calendar day, so
    a deal with a huge share of all serials stays small in the per-deal step.
    """
    by_day = serials.groupBy(DEAL, F.col("data_servico").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("has_order").alias("with_order")
    )
    dated = F.col("day").isNotNull()
    return by_day.groupBy(DEAL).agg(
        F.sum("n").alias("qtd_enviada"),
        F.sum(F.when(~dated, F.col("with_order")).otherwise(0)).alias("undated_installs"),
        F.collect_list(F.when(dated, F.struct("day", "n"))).alias("service_days"),
    )


def installed_since(start):
    """Installed serials of an ``installs_by_deal`` row for one contract start."""
    since = F.filter("service_days", lambda d: d["day"] >= start)
    return F.col("undated_installs") + F.aggregate(
        since, F.lit(0).cast("bigint"), lambda total, d: total + d["n"]
    )


def scheduled(tickets: DataFrame, deals: DataFrame | None = None) -> DataFrame:
    """Devices with an effective appointment, per deal."""
    qty = "instalacao__qtd_dispositivos_efetivamente_agendados"
    open_jobs = positive(in_scope(tickets, SERVICE_PIPELINE, SCHEDULED_STATUS), qty)
    if deals is not None:
        open_jobs = keep_in(open_jobs, deals, DEAL)
    return open_jobs.groupBy(DEAL).agg(F.sum(qty).alias("qtd_agendado"))
