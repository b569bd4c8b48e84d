"""Maintenance of keyed snapshot tables as DataFrame merges."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldfit.config import MIN_PAYLOAD_ROWS
from fieldfit.operators.relational import distinct_keys, drop_in, latest_per_key

ORDER = ("arrival_file", "arrival_pos")
CARRIED = "arrival_keys"
ARRIVAL = (*ORDER, CARRIED)


def last_arrivals(updates: DataFrame, keys: list[str], order=None) -> DataFrame:
    """The last row per key of a payload, by arrival order if it carries one."""
    arrival = [c for c in (order or ORDER) if c in updates.columns]
    ranked = [F.desc(c) for c in arrival]
    others = [F.desc(c) for c in updates.columns if c not in {*keys, *arrival, CARRIED}]
    last = latest_per_key(updates, keys, ranked or others, others if ranked else [])
    return last.drop(*arrival, CARRIED)


def last_carried(updates: DataFrame, keys: list[str], order=None) -> DataFrame:
    """Per key and column, the value of the last row that carried the column.

    A value is a one-field struct: NULL where no row carried the column, a struct
    of NULL where one carried it as NULL. Without ``arrival_keys`` every row
    carries every column.
    """
    values = [c for c in updates.columns if c not in {*keys, *(order or ()), *ARRIVAL}]
    if not values:
        return distinct_keys(updates, *keys)
    boxed = {c: F.struct(F.col(c).alias("value")) for c in values}
    if CARRIED not in updates.columns:
        return last_arrivals(updates, keys, order).withColumns(boxed)
    arrival = F.struct(*[c for c in (order or ORDER) if c in updates.columns])
    last = [F.max_by(boxed[c], F.when(F.array_contains(CARRIED, c), arrival)).alias(c) for c in values]
    return updates.groupBy(*keys).agg(*last)


def upsert(base: DataFrame, updates: DataFrame, keys: list[str], order=None) -> DataFrame:
    """Insert new keys, update the payload's columns of known keys.

    A matched row takes the payload's value even where that is NULL; columns
    its payload rows do not carry keep the base value. A payload column that the
    base lacks is added to it. Both sides are unique per key when they meet, so
    no key can be hot.
    """
    new = last_carried(updates, keys, order)
    b, u = base.alias("b"), new.alias("u")
    matched = reduce(lambda x, y: x & y, [F.col(f"b.{k}") == F.col(f"u.{k}") for k in keys])
    merged = b.join(u, matched, "full_outer")
    out = []
    for c in base.columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"u.{c}"), F.col(f"b.{c}")).alias(c))
        elif c in new.columns:
            cast = F.col(f"u.{c}.value").cast(base.schema[c].dataType)
            out.append(F.when(F.col(f"u.{c}").isNotNull(), cast).otherwise(F.col(f"b.{c}")).alias(c))
        else:
            out.append(F.col(f"b.{c}").alias(c))
    added = [F.col(f"u.{c}.value").alias(c) for c in new.columns if c not in base.columns]
    return merged.select(*out, *added)


def remove_stale(base: DataFrame, current: DataFrame, key: str, min_rows: int = MIN_PAYLOAD_ROWS) -> DataFrame:
    """Base rows whose key is still in the payload.

    A payload of fewer than ``min_rows`` rows counts as partial and removes
    nothing.
    """
    seen = distinct_keys(current, key).withColumn("_seen", F.lit(True))
    partial = current.agg(F.count(F.lit(1)) < min_rows).scalar()
    return base.join(seen, key, "left").filter(F.col("_seen") | partial).drop("_seen")


def stale_keys(base: DataFrame, current: DataFrame, key: str, min_rows: int = MIN_PAYLOAD_ROWS) -> DataFrame:
    """Keys that ``remove_stale`` drops."""
    enough = current.agg(F.count(F.lit(1)) >= min_rows).scalar()
    return drop_in(distinct_keys(base, key), current, key).filter(enough)


def replace_by_key(base: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Drop the base rows of every key present in ``rows``, then add ``rows``.

    Columns of the base that ``rows`` lacks are NULL in them.
    """
    known = rows.select(*[c for c in rows.columns if c in base.columns])
    return drop_in(base, rows, key).unionByName(known, allowMissingColumns=True)


def _usable(updates: DataFrame, key: str, cols: list[str], skip: str) -> DataFrame:
    """Payload rows a patch applies: non-empty key, and value not NULL / not falsy."""
    keep = F.col(key).isNotNull() & (F.col(key).cast("string") != "")
    for c in cols:
        keep = keep & F.col(c).isNotNull()
        if skip == "falsy":
            text = updates.schema[c].dataType.typeName() == "string"
            keep = keep & (F.col(c) != F.lit("" if text else 0))
    return updates.filter(keep)


def patch(
    base: DataFrame, updates: DataFrame, key: str, cols: list[str], skip: str = "null", order=None
) -> DataFrame:
    """Update matched rows only; never insert."""
    arrival = [c for c in (order or ORDER) if c in updates.columns]
    usable = _usable(updates, key, cols, skip).select(key, *cols, *arrival)
    new = last_arrivals(usable, [key], order).withColumnsRenamed({c: f"_new_{c}" for c in cols})
    joined = base.join(new, key, "left")
    values = {
        c: F.coalesce(F.col(f"_new_{c}").cast(base.schema[c].dataType), F.col(c)) for c in cols
    }
    return joined.withColumns(values).select(*base.columns)


def patch_counts(base: DataFrame, updates: DataFrame, key: str, cols: list[str], skip: str = "null") -> DataFrame:
    """Payload rows that met an existing row, and payload rows in all."""
    known = distinct_keys(base, key).withColumn("_known", F.lit(True))
    met = _usable(updates, key, cols, skip).groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(known, key)
    updated = met.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("updated"))
    return updated.select("updated", updates.agg(F.count(F.lit(1))).scalar().alias("total"))


def stamp(df: DataFrame, as_of: dt.datetime, col: str = "synced_at") -> DataFrame:
    """Default sync time for rows that carry none."""
    now = F.lit(as_of).cast("timestamp")
    return df.withColumn(col, F.coalesce(F.col(col).cast("timestamp"), now) if col in df.columns else now)
