"""Weekly and monthly distribution of grades over a fixed company set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldfit.config import GRADE_LABELS, NO_DATA


def grade_evolution(scores: DataFrame, companies: DataFrame, grade_col: str, week_col: str = "event_week") -> DataFrame:
    """Per week: companies per grade, companies without data, and the total.

    Companies without data are the total minus those graded in the week, so
    the (company x week) grid is never built.
    """
    fixed = companies.select("company_id").distinct()
    graded = (
        scores.filter(F.col(grade_col).isNotNull())
        .groupBy("company_id", F.col(week_col).cast("date").alias("snapshot_date"))
        .agg(F.max(F.col(grade_col).cast("int")).alias("grade"))
        .join(fixed, "company_id", "left_semi")
    )
    weeks = scores.select(F.col(week_col).cast("date").alias("snapshot_date")).distinct()
    counts = graded.groupBy("snapshot_date").agg(
        *[F.count_if(F.col("grade") == int(g)).alias(g) for g in GRADE_LABELS]
    )
    total = fixed.agg(F.count(F.lit(1))).scalar()
    known = [F.coalesce(F.col(g), F.lit(0)) for g in GRADE_LABELS]
    wide = weeks.join(counts, "snapshot_date", "left").select(
        "snapshot_date",
        *[k.alias(g) for k, g in zip(known, GRADE_LABELS)],
        total.alias("total_companies"),
    )
    wide = wide.withColumn(NO_DATA, F.col("total_companies") - sum(F.col(g) for g in GRADE_LABELS))
    return wide.unpivot(
        ["snapshot_date", "total_companies"], [*GRADE_LABELS, NO_DATA], "grade", "company_count"
    ).select("snapshot_date", "grade", "company_count", "total_companies")


def grade_evolution_monthly(weekly: DataFrame) -> DataFrame:
    """The last week of each month stands for the month.

    Partitions are calendar months of a table with six rows per week.
    """
    month = F.trunc("snapshot_date", "month")
    last = F.max("snapshot_date").over(Window.partitionBy(month))
    return weekly.withColumn("_last", last).filter("snapshot_date = _last").select(
        month.alias("month"), "grade", "company_count", "total_companies"
    )
