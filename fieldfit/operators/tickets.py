"""Ticket, field-visit and product tables from raw CRM extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldfit.config import CRM_PIPELINE_ID, CRM_STAGE_ID, CRM_STAGE_LABEL, QUANTITY_EXCLUDED, QUANTITY_PREFIX
from fieldfit.functions import display_name, split_list, split_suffix
from fieldfit.operators.relational import (
    distinct_keys,
    latest_per_key,
    pick_columns,
    sparse_left_join,
    wide_to_long,
)


def field_status(events: DataFrame) -> DataFrame:
    """Field events with the ticket id and visit number of their order text."""
    ticket, number = split_suffix(F.col("ordem_de_servico"))
    return events.select(
        F.col("ordem_de_servico").alias("ordem_servico_raw"),
        ticket.alias("ticket_id"),
        number.alias("suffix_num"),
        "status",
        "prestador",
        "consultor",
        F.col("data_agendada").cast("date").alias("data_agendada"),
        "cliente",
    )


def field_main(field: DataFrame, main: str = "unsuffixed") -> DataFrame:
    """Main visit per ticket.

    ``unsuffixed``: rows without a visit number; ``lowest``: the row without a
    number or else the one with the lowest.
    """
    if main == "unsuffixed":
        return field.filter(F.col("suffix_num").isNull())
    return latest_per_key(
        field, ["ticket_id"], [F.asc_nulls_first("suffix_num")], [F.asc("ordem_servico_raw")]
    )


def ticket_scope(
    raw: DataFrame,
    field: DataFrame,
    pipeline: str = CRM_PIPELINE_ID,
    stage: str = CRM_STAGE_ID,
    pipeline_col: str = "hs_pipeline",
    stage_col: str = "hs_pipeline_stage",
    key: str = "ticket_id",
) -> DataFrame:
    """Tickets in the pipeline's stage, plus those that left it but have a field record."""
    visited = distinct_keys(field, key).withColumn("_visited", F.lit(True))
    in_stage = F.coalesce((F.col(pipeline_col) == pipeline) & (F.col(stage_col) == stage), F.lit(False))
    return (
        raw.join(visited, key, "left")
        .withColumn("in_agendar_instalacao", in_stage)
        .filter("in_agendar_instalacao or _visited")
        .drop("_visited")
    )


def with_owner_name(tickets: DataFrame, owners: DataFrame) -> DataFrame:
    """Owner id -> owner name; tickets without an owner keep a NULL name."""
    return sparse_left_join(tickets, owners, "owner_hubspot_id", ["ticket_id"])


def tickets(
    raw: DataFrame,
    field: DataFrame,
    names: DataFrame | None,
    owners: DataFrame,
    owner_col: str = "ops_owner",
    url_prefix: str | None = None,
    stage_label: str = CRM_STAGE_LABEL,
) -> DataFrame:
    """The ticket table: scope, dates, class, serials, owner, company, deal, name.

    ``names`` has one row per company (company_id, company_name), ``owners``
    one per owner (owner_hubspot_id, owner_name). Without ``names`` the name shown is
    the subject's, to be replaced where the company's is known.
    """
    serials, count = split_list(F.col("ops__instalacao__esns"))
    scoped = ticket_scope(raw.withColumnRenamed("hs_object_id", "ticket_id"), field)
    rows = scoped.withColumns({"esn_list": serials, "esn_count": count}).withColumnRenamed(
        owner_col, "owner_hubspot_id"
    )
    if names is None:
        rows = rows.withColumn("company_name", F.lit(None).cast("string"))
    else:
        rows = sparse_left_join(rows, names, "company_id", ["ticket_id"])
    rows = with_owner_name(rows, owners)
    url = F.concat(F.lit(url_prefix), F.col("ticket_id")) if url_prefix else F.lit(None).cast("string")
    return rows.select(
        "ticket_id",
        F.col("subject").alias("subject_raw"),
        display_name(F.col("subject"), F.col("company_name")).alias("display_name"),
        F.col("hs_pipeline_stage").alias("pipeline_stage_id"),
        F.when(F.col("in_agendar_instalacao"), stage_label).alias("pipeline_stage_label"),
        F.col("ops__instalacao__classe").alias("classe_instalacao"),
        "owner_hubspot_id",
        "owner_name",
        "company_id",
        "deal_id",
        "createdate",
        "esn_count",
        "esn_list",
        url.alias("hubspot_url"),
        "in_agendar_instalacao",
    )


def with_product_label(quantities: DataFrame, labels: DataFrame) -> DataFrame:
    """Product property -> display label; an unlisted property keeps its name."""
    return quantities.join(labels, "property", "left").withColumn(
        "product_label", F.coalesce("product_label", "property")
    )


def ticket_products(raw: DataFrame, labels: DataFrame, key: str = "ticket_id") -> DataFrame:
    """(ticket, label, quantity); properties sharing a label are summed."""
    columns = pick_columns(raw, QUANTITY_PREFIX, QUANTITY_EXCLUDED)
    long = wide_to_long(raw, [key], columns)
    return (
        with_product_label(long, labels)
        .groupBy(key, "product_label")
        .agg(F.sum("quantity").alias("quantity"))
    )
