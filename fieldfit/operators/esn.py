"""Device-serial (ESN) ownership validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldfit.config import SERVICE_PIPELINE, TO_SCHEDULE_STATUS
from fieldfit.operators.relational import beside, explode_items, has_items, in_scope, latest_per_key

OK, DIVERGENT, UNMATCHED = "ok", "divergente", "sem_match"


def expected_serials(tickets: DataFrame) -> DataFrame:
    """(ticket, company, serial) expected by the tickets still to be scheduled."""
    scope = in_scope(tickets, SERVICE_PIPELINE, TO_SCHEDULE_STATUS)
    scope = has_items(scope.filter(F.col("company_id").isNotNull()), "instalacao__esns_processados")
    return explode_items(
        scope.select("ticket_id", "company_id", "instalacao__esns_processados"),
        "instalacao__esns_processados",
        "esn",
    )


def newest_delivery(deliveries: DataFrame) -> DataFrame:
    """Newest delivery per serial: its ticket is the current owner.

    Ranked beside the serial, so that a join on the serial can be split where
    many tickets expect the same one.
    """
    known = deliveries.filter(F.col("esn").isNotNull()).select(
        "esn", F.col("ticket_id_crm").alias("dono_ticket_id"), "modelo_item", "item_name", "created_at"
    )
    ties = [F.desc("dono_ticket_id"), F.desc("modelo_item"), F.desc("item_name")]
    known = known.withColumn("_beside", beside("esn"))
    return latest_per_key(known, ["esn", "_beside"], [F.desc("created_at")], ties).drop("created_at", "_beside")


def ticket_company(tickets: DataFrame) -> DataFrame:
    """Distinct ticket -> company pairs over all tickets, as owner columns.

    Rows of a ticket lie together before repeated ones go, so a join on it needs no shuffle more.
    """
    return (
        tickets.filter(F.col("company_id").isNotNull())
        .select(F.col("ticket_id").alias("dono_ticket_id"), F.col("company_id").alias("dono_company_id"))
        .repartition("dono_ticket_id")
        .distinct()
    )


def current_owner(deliveries: DataFrame, tickets: DataFrame) -> DataFrame:
    """Current owner ticket and company of every delivered serial."""
    return newest_delivery(deliveries).join(ticket_company(tickets), "dono_ticket_id", "left")


def esn_validation(
    tickets: DataFrame, deliveries: DataFrame, unique: bool = False, owners: DataFrame | None = None
) -> DataFrame:
    """Expected against current owner: ok, divergente or sem_match per pair.

    Companies are resolved for the newest delivery of every serial, one row each, and
    neither for the whole delivery history nor for every expected pair. ``unique`` gives
    one row per (ticket, serial), as a keyed snapshot needs: repeated serials
    count once, and of several companies of an owner ticket the expected one or
    else the smallest is taken; the pairs of a ticket, which come from one array
    cell, then lie together. ``owners`` holds the same tickets without their serials,
    where those have to be computed.
    """
    expected = expected_serials(tickets)
    if unique:
        expected = expected.distinct()
    owned = expected.join(current_owner(deliveries, tickets if owners is None else owners), "esn", "left")
    status = (
        F.when(F.col("dono_company_id").isNull(), UNMATCHED)
        .when(F.col("dono_company_id") == F.col("company_id"), OK)
        .otherwise(DIVERGENT)
    )
    if unique:
        fits = F.coalesce(F.col("dono_company_id") == F.col("company_id"), F.lit(False))
        owned = latest_per_key(owned.repartition("ticket_id"), ["ticket_id", "esn"], [fits.desc(), F.asc("dono_company_id")], [F.asc("company_id")])
    return owned.select(
        "ticket_id",
        F.col("company_id").alias("company_id_esperado"),
        "esn",
        "modelo_item",
        "item_name",
        "dono_ticket_id",
        "dono_company_id",
        status.alias("esn_status"),
    )


def esn_summary(pairs: DataFrame) -> DataFrame:
    """Pairs and distinct tickets per status."""
    return pairs.groupBy("esn_status").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_distinct("ticket_id").alias("tickets")
    )


def esn_by_ticket(pairs: DataFrame) -> DataFrame:
    """Counts, distinct models and the ordered detail list per ticket.

    A ticket's pairs come from one array cell of one ticket row, which bounds
    the lists collected here.
    """
    detail = F.struct(
        "esn", "modelo_item", F.col("esn_status").alias("status"), "dono_ticket_id", "dono_company_id"
    )
    models = F.sort_array(F.collect_set("modelo_item"))
    return pairs.groupBy("ticket_id").agg(
        F.count_if(F.col("esn_status") == DIVERGENT).alias("esn_divergente_count"),
        F.count_if(F.col("esn_status") == UNMATCHED).alias("esn_sem_match_count"),
        F.when(F.size(models) > 0, models).alias("esn_modelos_raw"),
        F.array_sort(F.collect_list(detail)).alias("esn_detalhe"),
    )
