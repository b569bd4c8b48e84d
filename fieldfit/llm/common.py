"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldfit.session import scratch_path

# A value counts as hot from this many rows on; at most HOT_VALUES values are
# treated as hot, so a list of them may always be broadcast. A value outside the
# list holds less than one row in HOT_VALUES of the table.
HOT_ROWS = 1000
HOT_VALUES = 2000


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder.

    Later reads survive lost executors, and both inputs of a later join are plain
    exchanges, which adaptive execution may split.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hottest(df: DataFrame, *keys: str, rows: int = HOT_ROWS) -> DataFrame:
    """The at most HOT_VALUES most frequent values of ``keys`` with ``rows`` rows or more."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= rows)
    return counts.orderBy(F.desc("_rows"), *keys).limit(HOT_VALUES).select(*keys)


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, lengthened until ``df`` has none of them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        out.append(name)
        taken.add(name.lower())
    return out


def keep_rows(docs: DataFrame, decisions: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` (key, ``text_key``, ``kept``) keeps.

    A row is known by its key and the hash of its text. Of rows equal in both, one
    stays if any is kept. Only rows that a decision touches beyond plainly keeping
    them (dropped or repeated ones) reach the join's small side.
    """
    hashed, = free_name(docs, "_text_key")
    touched = stored(
        decisions.groupBy(F.col(key).alias("_k"), F.col("text_key").alias("_t"))
        .agg(F.max("kept").alias("_kept"), F.count(F.lit(1)).alias("_n"))
        .where("not _kept or _n > 1"),
        "touched-rows",
    )
    rows = docs.withColumn(hashed, F.xxhash64(F.col(f"`{text}`")))

    def same(side: DataFrame):
        return rows[f"`{key}`"].eqNullSafe(side["_k"]) & (rows[f"`{hashed}`"] == side["_t"])

    plain = rows.join(touched, same(touched), "left_anti")
    again = touched.where("_kept")
    if not again.isEmpty():
        order = Window.partitionBy(F.col(f"`{key}`"), F.col(f"`{hashed}`")).orderBy(F.lit(0))
        nth, = free_name(rows, "_nth")
        repeats = rows.join(again, same(again), "left_semi").withColumn(nth, F.row_number().over(order))
        plain = plain.unionByName(repeats.where(F.col(f"`{nth}`") == 1).drop(nth))
    return plain.drop(hashed)


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of the undirected ``edges`` (``a``, ``b``).

    Each round sends every node to the lowest of its neighbourhood in a hashed
    order and contracts the graph to those, which shrinks paths as well as stars
    by a constant factor; per-node minima are pre-aggregated before the shuffle, so
    a hub of any degree is harmless. Every round is a table in the shared folder.
    """
    edges = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    whole = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
        step = stored(
            both.groupBy("a").agg(F.min(ranked("b")).alias("low")).select(
                "a", F.least(F.col("low"), ranked("a"))["n"].alias("up")
            ),
            "hooks",
        )
        if whole is None:
            whole = step.select(F.col("a").alias("node"), F.col("up").alias("root"))
        else:
            up = step.withColumnsRenamed({"a": "root"})
            whole = whole.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        whole = stored(whole, "roots")
        left, right = step.select("a", F.col("up").alias("ua")), step.select(F.col("a").alias("b"), F.col("up").alias("ub"))
        edges = stored(
            edges.join(left, "a").join(right, "b").where("ua <> ub")
            .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(),
            "edges",
        )
        if edges.isEmpty():
            return whole
