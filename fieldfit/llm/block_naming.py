"""Exact duplicates by deterministic block naming.

Every normalised text is cut into blocks of a fixed number of characters. Equal
blocks get one integer name: within a bucket the distinct blocks are sorted and
numbered. Then names of adjacent blocks are named as pairs, level by level, until
one name is left per document. A name stands for exactly one text: the hash picks
the bucket only, the rank inside it comes from comparing the blocks themselves, so
two documents share an identity only if their texts are equal.

Names depend on the data alone, not on partitioning, so a recomputed task gives
the same ones. A value that many rows share (a third of all rows may be copies of
one text) never meets in one task: the few hottest values are numbered as a list
of bounded size, which is broadcast, and only the other rows are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldfit.llm.common import HOT_ROWS, HOT_VALUES, hottest, keep_rows, stored

BLOCK_CHARS = 4096
BUCKET_BITS = 20

# Matches only what normalising changes: a run that is not one single blank.
UNEVEN_SPACE = r"[\t-\r][\x20\t-\r]*|\x20[\x20\t-\r]+"


def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one blank; NULL becomes the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), UNEVEN_SPACE, " ")


def blocks_of(text: Column, size: int) -> Column:
    """The text in pieces of ``size`` characters; the empty text is one empty piece."""
    return F.when(F.length(text) <= size, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    )


def numbered(df: DataFrame, bucket: Column, keys: list[str]) -> DataFrame:
    """Adds ``_name``: the rank of the key among the bucket's sorted keys, then the bucket."""
    ranked = Window.partitionBy("_bucket").orderBy(*keys)
    return (
        df.withColumn("_bucket", bucket.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)))
        .withColumn("_name", F.shiftleft(F.dense_rank().over(ranked).cast("bigint"), BUCKET_BITS) + F.col("_bucket"))
        .drop("_bucket")
    )


def named_texts(df: DataFrame, hot_rows: int) -> DataFrame:
    """``block`` replaced by ``_name``.

    ``_hash`` only finds the hot blocks: at most HOT_VALUES hashes of blocks of at
    most BLOCK_CHARS characters are broadcast. Their names are negative.
    """
    hot = F.broadcast(hottest(df, "_hash", rows=hot_rows))
    kept = F.broadcast(
        numbered(df.join(hot, "_hash", "left_semi").select("_hash", "block").distinct(), F.col("_hash"), ["block"])
        .select("block", (-F.col("_name")).alias("_hot"))
    )
    marked = df.join(kept, "block", "left")
    cold = numbered(marked.where(F.col("_hot").isNull()), F.col("_hash"), ["block"])
    return cold.drop("block", "_hash", "_hot").unionByName(
        marked.where(F.col("_hot").isNotNull()).withColumn("_name", F.col("_hot")).drop("block", "_hash", "_hot")
    )


def named_pairs(df: DataFrame, hot_rows: int) -> DataFrame:
    """``_left`` and ``_right`` replaced by ``_name``; a hot pair gets a negative one."""
    bucket = F.xxhash64("_left", "_right")
    hot = F.broadcast(numbered(hottest(df, "_left", "_right", rows=hot_rows), bucket, ["_left", "_right"]).withColumnRenamed("_name", "_hot"))
    marked = df.join(hot, ["_left", "_right"], "left")
    cold = numbered(marked.where(F.col("_hot").isNull()), bucket, ["_left", "_right"])
    return cold.drop("_left", "_right", "_hot").unionByName(
        marked.where(F.col("_hot").isNotNull()).withColumn("_name", -F.col("_hot")).drop("_left", "_right", "_hot")
    )


def identities(
    docs: DataFrame, text: str = "text", carry: tuple[str, ...] = (), block_chars: int = BLOCK_CHARS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per row of ``docs``: ``carry``, ``text_sha256``, ``_level`` and ``_name``.

    Two rows have equal (``_level``, ``_name``) if and only if their normalised
    texts are equal. ``_level`` is the number of namings the text's length needs.
    """
    norm = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.struct(*[F.col(f"`{c}`").alias(c) for c in carry]).alias("_carry") if carry else F.lit(None).alias("_carry"),
        normalised(F.col(f"`{text}`")).alias("_text"),
    )
    cut = norm.select(
        "_row",
        "_carry",
        F.unhex(F.sha2("_text", 256)).alias("_sha"),
        F.posexplode(blocks_of(F.col("_text"), block_chars)).alias("_pos", "block"),
    ).select(
        "_row",
        "_pos",
        F.when(F.col("_pos") == 0, F.struct("_sha", "_carry")).alias("_head"),
        F.xxhash64("block").alias("_hash"),
        "block",
    )
    level = stored(named_texts(cut, hot_rows), "block-names")
    depth, done = 0, []
    while True:
        # the last position of a document tells how many names it still has
        last = level.groupBy("_row").agg(
            F.max("_pos").alias("_last"), F.max("_head").alias("_head"), F.max(F.when(F.col("_pos") == 0, F.col("_name"))).alias("_name")
        )
        if depth == 0:
            last = stored(last, "block-heads")
            heads, longest = last, last.agg(F.max("_last")).first()[0]
        done.append(last.where(F.col("_last") == 0).select("_row", F.lit(depth).alias("_level"), "_name"))
        if not longest:
            break
        rest = last.where(F.col("_last") > 0).select("_row")
        pairs = (
            level.join(rest, "_row", "left_semi")
            .groupBy("_row", F.shiftright("_pos", 1).alias("_pos"))
            .agg(
                F.max(F.when(F.col("_pos") % 2 == 0, F.col("_name"))).alias("_left"),
                F.coalesce(F.max(F.when(F.col("_pos") % 2 == 1, F.col("_name"))), F.lit(0)).alias("_right"),
            )
        )
        pairs = stored(pairs.withColumn("_head", F.lit(None).cast(level.schema["_head"].dataType)), "name-pairs")
        level = stored(named_pairs(pairs, hot_rows), "pair-names")
        depth, longest = depth + 1, longest // 2
    names = done[0]
    for more in done[1:]:
        names = names.unionByName(more)
    out = names.join(heads.select("_row", "_head"), "_row")
    picked = [F.col(f"_head._carry.`{c}`").alias(c) for c in carry]
    return out.select("_row", *picked, F.lower(F.hex("_head._sha")).alias("text_sha256"), "_level", "_name")


def exact_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per row of ``docs``: key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``,
    ``text_key`` (hash of the text as it stands).

    * NULL text counts as the empty text; texts equal after normalising white space
      form a group, of which the row with the smallest key stays.
    * A NULL key sorts last; a group with NULL keys only has ``keep_id`` NULL.
    * Of several rows with the smallest key (repeated rows), exactly one stays.
    * Other columns of ``docs`` are not looked at and may have any name; an empty
      table gives an empty result.
    """
    docs = docs.select(
        F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"), F.xxhash64(F.col(f"`{text}`")).alias("text_key")
    )
    named = identities(docs, "_text", ("_key", "text_key"), block_chars, hot_rows)
    named = stored(named, "identities")
    order = F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("id"), F.col("_row").alias("row"))
    ident = ["_level", "_name"]
    groups = stored(
        named.groupBy(*ident).agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1"),
        "copy-groups",
    )
    # the largest groups (a bounded list) reach their rows by broadcast, the others by shuffle
    hot = groups.where(F.col("group_size") >= hot_rows).orderBy(F.desc("group_size"), *ident).limit(HOT_VALUES)
    marked = named.join(F.broadcast(hot.withColumnsRenamed({"_first": "_f", "group_size": "_n"})), ident, "left")
    rest = marked.where(F.col("_n").isNull()).drop("_f", "_n").join(groups, ident, "left")
    whole = rest.unionByName(marked.where(F.col("_n").isNotNull()).withColumnsRenamed({"_f": "_first", "_n": "group_size"}))
    return whole.select(
        F.col("_key").alias(key),
        F.when(F.col("_first").isNull(), F.col("_key")).otherwise(F.col("_first.id")).alias("keep_id"),
        F.coalesce(F.col("group_size"), F.lit(1).cast("bigint")).alias("group_size"),
        F.coalesce(F.col("_first.row") == F.col("_row"), F.lit(True)).alias("kept"),
        "text_sha256",
        "text_key",
    )


def kept_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay when every group keeps one.

    * The row with the smallest key stays; one of rows equal in key and text.
    * A NULL text is equal to an empty one. Rows with a NULL key stay only where
      ``exact_duplicates`` marks them as kept.
    * Other columns may have any name; an empty table gives an empty result.
    """
    return keep_rows(docs, exact_duplicates(docs, key, text), key, text)


SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
  SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""
