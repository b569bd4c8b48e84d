"""Serial validation end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fieldfit.operators.esn import esn_summary, esn_validation


def validation_report(tickets: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Pairs and tickets per validation status."""
    return esn_summary(esn_validation(tickets, deliveries))
