"""Generic row, key and join operators, parameterised by column name."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# --- projection -----------------------------------------------------------

def project(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Select and rename: ``{published name: source column}``."""
    return df.select(*[F.col(src).alias(name) for name, src in mapping.items()])


def pick_columns(df: DataFrame, prefix: str, exclude: str) -> list[str]:
    """Columns found by name, because the extract may grow new ones."""
    return [c for c in df.columns if c.startswith(prefix) and exclude not in c]


# --- filters --------------------------------------------------------------

def where_in(df: DataFrame, col: str, values) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def where_not_in(df: DataFrame, col: str, values) -> DataFrame:
    """NULL is not kept, as in SQL."""
    return df.filter(~F.col(col).isin(*values))


def where_not_prefixed(df: DataFrame, col: str, prefixes) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [~F.col(col).startswith(p) for p in prefixes]))


def drop_denied(df: DataFrame, col: str, denied) -> DataFrame:
    """Drop rows of a deny-list: a sequence of literals, or a one-column table."""
    if isinstance(denied, DataFrame):
        return not_in(df, denied.select(F.col(denied.columns[0]).alias(col)), col)
    return where_not_in(df, col, denied) if denied else df


def signed_since(df: DataFrame, date: dt.date, col: str = "data_inicio_assinatura") -> DataFrame:
    return df.filter(F.col(col) >= F.lit(date))


def in_scope(
    df: DataFrame,
    pipeline: str,
    status: str | None = None,
    pipeline_col: str = "pipeline_label",
    status_col: str = "ticket_status",
) -> DataFrame:
    keep = F.col(pipeline_col) == pipeline
    return df.filter(keep if status is None else keep & (F.col(status_col) == status))


def has_items(df: DataFrame, arr: str) -> DataFrame:
    return df.filter(F.col(arr).isNotNull() & (F.size(arr) > 0))


def positive(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) > 0)


def search(df: DataFrame, term: str, cols) -> DataFrame:
    """Rows where any of the columns contains the term, ignoring case."""
    hits = [F.coalesce(F.lower(F.col(c).cast("string")).contains(term.lower()), F.lit(False)) for c in cols]
    return df.filter(reduce(lambda a, b: a | b, hits))


# --- keys -----------------------------------------------------------------

def latest_per_key(df: DataFrame, keys, order, ties=()) -> DataFrame:
    """First row per key in the given order (a total order with ``ties``).

    The rank filter is applied in every map task before the shuffle, so a hot
    key sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def beside(*keys: str) -> Column:
    """Always 0, but computed from the keys.

    A side grouped or ranked by the keys and this column has a partitioning that
    a join on the keys alone cannot take over. Spark then shuffles both inputs of
    the join for it, and only such joins can be split at a hot key.
    """
    return F.pmod(F.xxhash64(*keys), F.lit(1))


def key_set(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys as the small side of a join that may have to be split."""
    return df.groupBy(key, beside(key).alias("_beside")).agg(F.lit(0).alias("_none")).select(key)


def keep_in(df: DataFrame, keys_df: DataFrame, key: str) -> DataFrame:
    """Semi join; the key side is reduced to distinct keys before its shuffle."""
    return df.join(key_set(keys_df, key), key, "left_semi")


def drop_in(df: DataFrame, keys_df: DataFrame, key: str) -> DataFrame:
    """Anti join that drops true matches only; NULL keys stay."""
    return df.join(key_set(keys_df, key), key, "left_anti")


def not_in(df: DataFrame, sub: DataFrame, key: str) -> DataFrame:
    """SQL ``NOT IN (subquery)`` as a shuffled join.

    One NULL in the subquery empties the result, a NULL probe is dropped, and
    an empty subquery keeps every row. The null-aware join of the SQL form always
    broadcasts; here the two facts are one scalar subquery, which runs with the
    query and not while it is built.

    A marked left join stays where it is written and shares its neighbours'
    partitioning; an anti join would be pushed down to a shuffle of its own.
    """
    marked = key_set(sub.filter(F.col(key).isNotNull()), key).withColumn("_hit", F.lit(True))
    joined = sparse_left_join(df, marked, key, [c for c in df.columns if c != key] or [key])
    return joined.filter(outside(sub, key, "_hit")).drop("_hit").select(*df.columns)


def outside(sub: DataFrame, key: str, hit: str) -> Column:
    """Condition of ``NOT IN`` for rows whose ``hit`` says that ``sub`` holds their key."""
    facts = sub.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("nulls")).alias("f")).scalar()
    return (facts["n"] == 0) | (F.col(hit).isNull() & F.col(key).isNotNull() & (facts["nulls"] == 0))


# --- joins ----------------------------------------------------------------

def sparse_left_join(left: DataFrame, right: DataFrame, key: str, spread_by: list[str]) -> DataFrame:
    """Left equi-join for a probe key that is often NULL.

    NULL keys match nothing, yet a hash partitioning would send them all to
    one task; a second key, fixed for real keys, spreads them over all tasks.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(*spread_by)).otherwise(F.lit(0).cast("bigint"))
    return (
        left.withColumn("_spread", spread)
        .join(right.filter(F.col(key).isNotNull()).withColumn("_spread", beside(key)), [key, "_spread"], "left")
        .drop("_spread")
    )


# --- reshaping ------------------------------------------------------------

def explode_items(df: DataFrame, arr: str, name: str) -> DataFrame:
    """One row per array item; NULL and empty arrays give none."""
    return df.withColumn(name, F.explode(arr)).drop(*([] if name == arr else [arr]))


def wide_to_long(
    df: DataFrame, id_cols: list[str], value_cols: list[str], name: str = "property", value: str = "quantity"
) -> DataFrame:
    """Wide quantity columns to (name, value) rows; zero, NULL and blank text are dropped.

    A quantity that is no whole number stops the query instead of being rounded
    or lost.
    """

    def quantity(c: str) -> Column:
        number = F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).cast("double")
        return F.when(number == F.floor(number), number.cast("bigint")).otherwise(
            F.when(number.isNotNull(), F.raise_error(F.format_string(f"{c} is no whole number: %s", F.col(c).cast("string"))).cast("bigint"))
        )

    whole = df.select(*id_cols, *[quantity(c).alias(c) for c in value_cols])
    return whole.unpivot(id_cols, value_cols, name, value).filter(F.coalesce(F.col(value), F.lit(0)) != 0)


# --- ordering -------------------------------------------------------------

def ordered(df: DataFrame, cols: list[str | Column]) -> DataFrame:
    return df.orderBy(*cols)
