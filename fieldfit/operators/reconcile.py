"""Reconciliation of two copies of a result by group totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_totals(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(m).alias(m) for m in measures]
    )


def reconcile(a: DataFrame, b: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Totals of both sides per key, their differences, and whether all agree."""
    left, right = group_totals(a, keys, measures).alias("a"), group_totals(b, keys, measures).alias("b")
    same_key = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    pairs = []
    diffs = []
    for m in ["rows", *measures]:
        x, y = F.coalesce(F.col(f"a.{m}"), F.lit(0)), F.coalesce(F.col(f"b.{m}"), F.lit(0))
        pairs += [x.alias(f"{m}_a"), y.alias(f"{m}_b"), (x - y).alias(f"{m}_diff")]
        diffs.append(x == y)
    agree = reduce(lambda x, y: x & y, diffs)
    shown = [F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys]
    return left.join(right, same_key, "full_outer").select(*shown, *pairs, agree.alias("agree"))
