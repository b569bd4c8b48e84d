"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Vectors are scaled into the unit ball and lifted onto the sphere, so that the
largest inner product is the smallest angle. Rotations learned on a bounded sample
turn a vector into a binary code, one bit per rotated coordinate. Codes are split
into one-byte substrings, and every index block keeps, per substring, the lists of
its codes by value. By the pigeonhole principle a code within Hamming radius r of
the query's lies within radius r // substrings of it in some substring, so probing
those values in every substring retrieves every code within the radius; the
retrieved codes are checked against the whole radius and reranked by inner products
of the original vectors in double precision.

Equal vectors share one entry: the index holds distinct vectors, each with its few
smallest ids, since no more of them can be among the nearest. Query blocks meet
index blocks, both of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldfit.llm.common import stored

NEAREST = 20
FIT_ROWS = 8192  # vectors the rotations and the radius are learned on, those with the lowest hash
CODE_BITS = 256
LEARNING_ROUNDS = 15
RADIUS_SHARE = 0.97  # share of true neighbours in the sample that the radius has to reach
INDEX_BLOCK = 16_384
QUERY_BLOCK = 4_096

VALUES = np.arange(256)
POPULATION = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def usable(vector: str):
    """A vector with finite components, not all of them zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


class Coder:
    """Learned rotations and the radius that goes with their codes."""

    def __init__(self, rotations: np.ndarray, largest: float, radius: int):
        self.rotations, self.largest, self.radius = rotations, largest, radius

    def lifted(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """On the unit sphere, with one more coordinate that evens out the norms."""
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        if query:
            return np.hstack([vectors / np.where(norms > 0, norms, 1), np.zeros_like(norms)])
        return np.hstack([vectors / self.largest, np.sqrt(np.maximum(0.0, 1.0 - (norms / self.largest) ** 2))])

    def codes(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """(rows, substrings) bytes."""
        return np.packbits(self.lifted(vectors, query) @ self.rotations > 0, axis=1)


def distances(code: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hamming distances of one code to all of ``codes``."""
    return np.bitwise_count(codes.view("<u8") ^ code.view("<u8")).sum(axis=1, dtype=np.int32)


def learn(sample: np.ndarray, largest: float, bits: int = CODE_BITS, nearest: int = NEAREST) -> Coder:
    """Rotations by alternating between codes and the rotation that fits them best
    (orthogonal Procrustes), from several random starts; then the radius."""
    coder = Coder(np.zeros((0, 0)), largest, bits)
    base = coder.lifted(sample, False)
    dim = base.shape[1]
    rng, found = np.random.default_rng(7), []
    for _ in range(-(-bits // dim)):
        r = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        for _ in range(LEARNING_ROUNDS):
            u, _, v = np.linalg.svd(base.T @ np.sign(base @ r))
            r = u @ v
        found.append(r)
    coder.rotations = np.hstack(found)[:, :bits]
    n = len(sample)
    probes = rng.permutation(n)[:256]
    codes, own = coder.codes(sample), coder.codes(sample[probes], query=True)
    reach = []
    for row, at in enumerate(probes):
        score = sample @ sample[at]
        score[at] = -np.inf
        top = np.argsort(-score)[: min(nearest, n - 1)]
        reach.append(distances(own[row], codes[top]))
    coder.radius = int(np.quantile(np.concatenate(reach), RADIUS_SHARE)) if n > 1 else bits
    return coder


class Block:
    """An index block: per substring, its codes sorted by value."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray):
        self.ids, self.vectors, self.codes = ids, vectors, np.ascontiguousarray(codes)
        self.columns = np.ascontiguousarray(codes.T)
        self.lists = [np.argsort(c, kind="stable") for c in self.columns]
        self.starts = [np.searchsorted(c[o], np.arange(257)) for c, o in zip(self.columns, self.lists)]

    def probe(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows of every code within the radius, found through their substrings.

        Few values to probe: their lists are read. Many: so much of the block is
        in their lists that the substring's column is tested instead.
        """
        within = radius // len(code)
        hit = np.zeros(len(self.ids), bool)
        for j, value in enumerate(code):
            near = POPULATION[VALUES ^ value] <= within
            if within < 2:
                starts, order = self.starts[j], self.lists[j]
                for v in np.flatnonzero(near):
                    hit[order[starts[v] : starts[v + 1]]] = True
            else:
                hit |= near[self.columns[j]]
                if hit.all():
                    break
        rows = np.flatnonzero(hit)
        return rows[distances(code, self.codes[rows]) <= radius]

    def search(self, query: np.ndarray, code: np.ndarray, radius: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``most`` best rows and their scores; the radius grows until it holds that many."""
        bits, rows = 8 * len(code), np.zeros(0, np.int64)
        while True:
            rows = self.probe(code, radius)
            if len(rows) >= min(most, len(self.ids)) or radius >= bits:
                break
            radius = min(bits, radius + max(4, bits // 16))
        score = np.einsum("ij,j->i", self.vectors[rows], query)
        best = np.lexsort((self.ids[rows], -score))[:most]
        return rows[best], score[best]


def neighbours(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    every: int = 20,
    nearest: int = NEAREST,
    index_block: int = INDEX_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the nearest rows of every query.

    Queries are the rows whose key is divisible by ``every``; candidates are all
    rows but the query's own.

    * A NULL key, a NULL or zero vector, one with NULL or non-finite components, and
      one of another length than most take no part. Rows repeated with key and
      vector count once; rows with the query's own key are never its candidates.
    * Ties go to the smaller key; fewer candidates than ``nearest`` are all
      returned. Other columns may have any name; an empty table gives an empty
      result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable("v")).distinct()
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = stored(rows.where(F.size("v") == (sizes["n"] if sizes else 0)), "vectors")
    # Distinct vectors; no query can have more than nearest + 1 of one vector's ids.
    ordered = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("nth", F.row_number().over(ordered)).where(F.col("nth") <= nearest + 1)
    distinct = few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("rep"), "ids", "v")
    # two vectors may share their smallest id: the hash tells them apart
    distinct = stored(distinct.withColumn("entry", F.xxhash64("rep", "v")), "distinct-vectors")
    asking = stored(
        rows.where(F.col("id") % every == 0).join(distinct.select("v", "entry"), "v").select(F.col("id").alias("query_id"), "entry"),
        "query-ids",
    )
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if not sizes:
        return spark.createDataFrame([], result)
    queries = stored(distinct.join(asking.select("entry").distinct(), "entry", "left_semi").select("entry", "v"), "queries")
    # Codes depend on directions and relative lengths only: with components of 1 at
    # most no square or norm overflows.
    unit = distinct.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]
    norm = F.sqrt(F.aggregate(F.transform("v", lambda x: x / unit), F.lit(0.0), lambda a, x: a + x * x))
    facts = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("m")).first()
    sample = distinct.orderBy(F.xxhash64("v"), "entry").limit(FIT_ROWS).select("v").collect()
    coder = learn(np.array([r["v"] for r in sample]) / unit, facts["m"], nearest=nearest)
    blocks = -(-facts["n"] // index_block)
    asked = -(-queries.count() // query_block)

    def coded(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    m = np.stack(batch["v"].to_numpy(zero_copy_only=False))
                    code = [bytes(c) for c in coder.codes(m / unit, query)]
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code, pa.binary())], [*batch.schema.names, "code"])

        return run

    index = distinct.select("entry", "rep", "v").mapInArrow(coded(False), "entry bigint, rep bigint, v array<double>, code binary")
    probes = queries.mapInArrow(coded(True), "entry bigint, v array<double>, code binary")
    at_index = index.select(
        F.pmod("entry", F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(asked - 1))).alias("part"), "entry", "rep", "v", "code"
    )
    at_query = probes.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"),
        F.pmod(F.xxhash64("entry"), F.lit(asked)).cast("int").alias("part"), "entry", "v", "code",
    )
    shape = "query bigint, entry bigint, rep bigint, score double"

    def search(held: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(held) and len(wanted):
            matrix = lambda c: np.stack(c.to_numpy())
            bytes_of = lambda c: np.stack([np.frombuffer(x, np.uint8) for x in c])
            entries = held["entry"].to_numpy()
            block = Block(held["rep"].to_numpy(), matrix(held["v"]), bytes_of(held["code"]))
            for query, v, code in zip(wanted["entry"], matrix(wanted["v"]), bytes_of(wanted["code"])):
                best, score = block.search(v, code, coder.radius, nearest + 1)
                out.append((np.full(len(best), query), entries[best], block.ids[best], score))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        return pd.DataFrame(dict(zip(("query", "entry", "rep", "score"), columns)))

    hits = at_index.groupBy("block", "part").cogroup(at_query.groupBy("block", "part")).applyInPandas(search, shape)
    leading = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    hits = hits.withColumn("nth", F.row_number().over(leading)).where(F.col("nth") <= nearest + 1)
    # Distinct vectors back to ids: at most nearest + 1 of each, of which the best are kept.
    named = hits.join(distinct.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    close = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    named = stored(named.withColumn("nth", F.row_number().over(close)).where(F.col("nth") <= 2 * nearest + 1), "neighbours")
    per_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = asking.join(named.drop("nth"), asking["entry"] == named["query"]).where("vec_id <> query_id")
    return (
        found.select("query_id", F.row_number().over(per_query).alias("rank"), "vec_id", "score").where(F.col("rank") <= nearest)
    )
