"""Runs of repeating words by a dictionary of basic factors.

For every power of two 2^k all stretches of 2^k words get a name, equal stretches
the same one; a name of level k + 1 stands for the pair of names of its halves. At
level k the next occurrence of a stretch proposes its distance d as a period if
2^(k-1) < d <= 2^k (distances up to twice the length of the level before). A stretch
at least as long as a period that repeats it has that period and no smaller one, so
its next occurrence is exactly one period away: inside a run the proposals stand at
consecutive words with the same distance, an arithmetic progression of occurrences,
and where they begin and end the run does. A maximal row of equal proposals from i
to j is thus one run, from i to j + d + 2^k, found at one level only; extending and
deduplicating are joining neighbours.

Stretches that occur once, or not again near enough, get no name and take no part in
higher levels. A text is one row; its work is that of a few sorts per level.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
LEAST_WORDS = 24
LEAST_TIMES = 3

words_of = re.compile(WORD.encode()).findall


def named(words: list[bytes]) -> np.ndarray:
    """A number per word, equal for equal words."""
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))


def period_runs(names: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> np.ndarray:
    """(start, length, period) of all runs, by start, then period.

    A run is a stretch with smallest period q of at least ``least`` and ``times * q``
    names that cannot be made longer. ``times`` is 3 or more.
    """
    if times < 3:
        raise ValueError("the levels find runs of three periods or more")
    n, found = len(names), [np.zeros((0, 3), np.int64)]
    farthest = n // times  # no period is longer
    at, name, length = np.arange(n), names, 1  # places of the stretches that may occur again, in order
    while n >= least and len(at):
        order = np.argsort(name, kind="stable")
        place = at[order]
        again = name[order][1:] == name[order][:-1]
        distance = place[1:] - place[:-1]
        near = again & (distance <= farthest)
        proposed = near & (distance > length // 2) & (distance <= length)
        i, d = place[:-1][proposed], distance[proposed]
        by_place = np.argsort(i)
        i, d = i[by_place], d[by_place]
        if len(i):
            first = np.flatnonzero(np.concatenate(([True], (np.diff(i) != 1) | (np.diff(d) != 0))))
            last = np.append(first[1:], len(i)) - 1
            size = i[last] - i[first] + d[first] + length
            long = size >= np.maximum(least, times * d[first])
            found.append(np.column_stack((i[first], size, d[first]))[long])
        if length >= farthest:
            break
        # the names of the next level: pairs of stretches that both occur again near by
        keep = np.zeros(len(place), bool)
        keep[:-1] |= near
        keep[1:] |= near
        number = np.full(n, -1, np.int64)
        number[place[keep]] = np.cumsum(np.concatenate(([0], ~again)))[keep]
        at = np.flatnonzero((number[: max(n - length, 0)] >= 0) & (number[length:] >= 0))
        name = number[at] * (n + 1) + number[at + length]
        length *= 2
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def outside(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each of ``n`` words stays when every run is cut to its first period."""
    ends = np.zeros(n + 1, np.int64)
    np.add.at(ends, runs[:, 0] + runs[:, 2], 1)
    np.add.at(ends, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(ends[:-1]) == 0


def periodic_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, times: int = LEAST_TIMES
) -> DataFrame:
    """One row per row of ``docs``: key, ``runs`` and ``collapsed``.

    * Words are runs without ASCII white space, numbered from 0. ``runs`` holds
      (start, length, period) of every stretch with smallest period q and at least
      ``least`` and ``times * q`` words that no neighbouring word extends, by start,
      then period. Runs may overlap.
    * ``collapsed`` is the words, joined by one space, without those that stand in
      some run after its first q words.
    * NULL and empty texts have no runs and collapse to the empty text. NULL and
      repeated keys keep their rows; other columns may have any name; an empty table
      gives an empty result.
    """
    kind = docs.schema[key].dataType.simpleString()

    def one(text: str | None) -> tuple[np.ndarray, str]:
        words = words_of((text or "").encode())
        runs = period_runs(named(words), least, times)
        if len(runs):
            words = [w for w, stays in zip(words, outside(len(words), runs).tolist()) if stays]
        return runs, b" ".join(words).decode()

    row = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, texts = zip(*(one(t.as_py()) for t in batch["_text"])) if batch.num_rows else ((), ())
            listed = pa.ListArray.from_arrays(
                np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32),
                pa.StructArray.from_arrays([pa.array(c) for c in np.concatenate([np.zeros((0, 3), np.int64), *runs]).T], fields=list(row)),
            )
            yield pa.RecordBatch.from_arrays([batch["_key"], listed, pa.array(texts, pa.string())], ["_key", "runs", "collapsed"])

    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    return rows.mapInArrow(
        run, f"_key {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    ).withColumnRenamed("_key", key)


def planted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``text``) with a repeating tail in a tenth of the documents.

    With h the CRC-32 of the key in decimal and g = h / 10, a document of n words with
    h % 10 = 0 repeats its p = 1 + (n - a) / (3 + g % 8) words from a = g % n on to its
    end. Documents without a key stay as they are.
    """
    h = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(WORD), F.lit(0))
    n = F.size("w")
    with_words = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"), g.alias("g"), F.when(h % 10 == 0, words).alias("w"))
    a = (F.col("g") % F.col("n")).cast("int")
    p = (F.lit(1) + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    tail = F.transform(F.sequence(F.col("a"), F.col("n") - 1), lambda i: F.get("w", F.col("a") + (i - F.col("a")) % F.col("p")))
    changed = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return (
        with_words.withColumn("n", F.when(F.col("w").isNotNull() & (n > 0), n))
        .withColumn("a", a)
        .withColumn("p", p)
        .select(F.col("k").alias(key), F.when(F.col("n").isNotNull(), changed).otherwise(F.col("t")).alias(text))
    )


def most_repeated(runs: Column) -> Column:
    """The run with the greatest length / period; of equal ones the first."""

    def better(best: Column, r: Column) -> Column:
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of the runs of ``docs`` with planted tails."""
    found = periodic_runs(planted(docs, key, text), key, text).withColumn("best", most_repeated(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        key,
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
