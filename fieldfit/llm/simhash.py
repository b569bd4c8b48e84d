"""Near duplicates by SimHash with a byte-position inverted index.

A fingerprint has 64 bits in eight bytes. Two fingerprints that differ in at most
``max_bits`` bits agree in at least ``8 - max_bits`` byte positions. The index files
every distinct fingerprint under combinations of positional bytes chosen such that
any pair with that many agreeing positions shares an entry; the pairs of an entry
are tallied by agreeing positions, those below the guaranteed minimum are dropped,
and the rest is verified bit by bit.

Copies collapse to one fingerprint before the index, so a large group of copies
costs one entry. An entry with more than ``max_entry`` fingerprints gives no pairs:
its members are linked through their one-bit variants instead (two fingerprints
differ in two bits or less exactly if they share such a variant), which is linear
in the members and loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldfit.llm.common import components, keep_rows, stored

SEED = 42
WORDS = 3
MAX_BITS = 2
MAX_ENTRY = 64
SLICE = 1 << 16


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words, repeats included."""
    parts = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(parts) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[words - 1 :].tolist())], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes; as a signed 64-bit integer."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLICE):
        rows = hashes[at : at + SLICE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.add.reduce(np.unpackbits(rows, axis=1, bitorder="little"), axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, ``text_key``, ``fp``) for every row: one pass, one text at a time."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(shingle_hashes(t.as_py(), words)) for t in batch["_text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["_key"], batch["text_key"], pa.array(fps, pa.int64())], ["_key", "text_key", "fp"]
            )

    rows = docs.select(
        F.col(f"`{key}`").alias("_key"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"), F.col(f"`{text}`").alias("_text")
    )
    return rows.mapInArrow(run, f"_key {kind}, text_key bigint, fp bigint")


def entry_masks(max_bits: int) -> list[int]:
    """Masks of the byte combinations of the index, as signed integers.

    The bytes form ``max_bits + 2`` groups; differing bits spoil at most
    ``max_bits`` of them, so at least two groups agree, and each pair of groups is
    an index position.
    """
    if not 0 <= max_bits <= 6:
        raise ValueError("max_bits must be from 0 to 6")
    groups = np.array_split(np.arange(8), max_bits + 2)
    masks = [sum(0xFF << (8 * int(b)) for g in pair for b in g) for pair in combinations(groups, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def agreeing_bytes(a: str, b: str):
    """Tally of the byte positions in which two fingerprints agree."""
    diff = F.col(a).bitwiseXOR(F.col(b))
    same = [F.when(diff.bitwiseAND(F.lit(0xFF << (8 * i) if i < 7 else -(1 << 56))) == 0, 1).otherwise(0) for i in range(8)]
    return reduce(lambda x, y: x + y, same)


def links(fps: DataFrame, max_bits: int = MAX_BITS, max_entry: int = MAX_ENTRY) -> DataFrame:
    """Edges (``a``, ``b``) that connect the same distinct ``fp`` as all true links do.

    Every edge joins fingerprints that differ in at most ``max_bits`` bits.
    """
    if max_bits > 2:
        raise ValueError("the linking of large index entries knows up to two bits")
    filed = stored(
        fps.select(
            "fp",
            F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in entry_masks(max_bits)])).alias("at", "bytes"),
        ),
        "byte-index",
    )
    sizes = stored(filed.groupBy("at", "bytes").count().where("count > 1"), "index-sizes")
    shared = filed.join(sizes, ["at", "bytes"])
    small = shared.where(F.col("count") <= max_entry).groupBy("at", "bytes").agg(F.collect_list("fp").alias("fps"))
    pairs = (
        small.select("fps", F.explode("fps").alias("a"))
        .select("a", F.explode("fps").alias("b"))
        .where("a < b")
        .where(agreeing_bytes("a", "b") >= 8 - max_bits)
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )
    # Large entries: a variant shared by two members proves their link.
    reach = max_bits // 2  # 1 for two bits: variants at distance 0 and 1
    flips = [0] + [1 << i if i < 63 else -(1 << 63) for i in range(64)] * reach
    large = shared.where(F.col("count") > max_entry).select("fp").distinct()
    variants = stored(
        large.select("fp", F.explode(F.array(*[F.lit(f) for f in flips])).alias("flip")).select(
            "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant")
        ),
        "variants",
    )
    lowest = stored(
        variants.groupBy("variant").agg(F.min("fp").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1"), "variant-lows"
    )
    through = variants.join(lowest, "variant").where("fp <> low").select(F.col("low").alias("a"), F.col("fp").alias("b"))
    if max_bits == 1:  # no shared variants at one bit: the flipped fingerprint itself must exist
        ones = large.select("fp", F.explode(F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)])).alias("flip"))
        other = large.select(F.col("fp").alias("b"))
        ones = ones.select(F.col("fp").alias("a"), F.col("fp").bitwiseXOR(F.col("flip")).alias("b"))
        through = ones.join(other, "b").select("a", "b")
    return pairs.unionByName(through)


def with_components(docs: DataFrame, key: str, text: str, words: int, max_bits: int, max_entry: int) -> DataFrame:
    """(``_key``, ``text_key``, ``fp``, ``first``) for every row.

    ``first`` is the lowest (key is NULL, key, text key) of the row's component, so
    that components without any key are told apart too.
    """
    rows = stored(fingerprints(docs, key, text, words), "fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min(F.struct(F.col("_key").isNull().alias("none"), "_key", "text_key")).alias("low")), "distinct-fingerprints")
    roots = components(links(fps, max_bits, max_entry)).withColumnRenamed("node", "fp")
    rooted = stored(fps.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "rooted-fingerprints")
    firsts = rooted.groupBy("root").agg(F.min("low").alias("first"))
    named = stored(rooted.join(firsts, "root").select("fp", "first"), "fingerprint-components")
    return rows.join(named, "fp").select("_key", "text_key", "fp", "first")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    max_bits: int = MAX_BITS,
    max_entry: int = MAX_ENTRY,
) -> DataFrame:
    """One row per row of ``docs``: key, ``text_key``, ``fingerprint``, ``component_id``.

    * Texts are lower-cased in A-Z; words are runs without ASCII white space. A text
      of fewer words than a shingle is one shingle; a NULL text or one without
      words has fingerprint zero, linked like any other.
    * ``component_id`` is the smallest key reachable over links, its own included;
      NULL keys are reached but never the smallest; NULL if there is no other.
    * Repeated rows and keys keep their rows; other columns may have any name; an
      empty table gives an empty result.
    """
    return with_components(docs, key, text, words, max_bits, max_entry).select(
        F.col("_key").alias(key), "text_key", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first._key").alias("component_id")
    )


def kept_rows(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    max_bits: int = MAX_BITS,
    max_entry: int = MAX_ENTRY,
) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when every component keeps one.

    * The row with the smallest key stays, NULL keys last; of several with that key
      the one with the lowest text hash, and one of rows equal in both.
    * NULL texts and texts without words have fingerprint zero and are linked like
      any other, so one of them stays.
    * Other columns may have any name; an empty table gives an empty result.
    """
    rows = with_components(docs, key, text, words, max_bits, max_entry)
    decided = rows.select(
        F.col("_key").alias(key),
        "text_key",
        (F.col("_key").eqNullSafe(F.col("first._key")) & (F.col("text_key") == F.col("first.text_key"))).alias("kept"),
    )
    return keep_rows(docs, stored(decided, "near-decisions"), key, text)
