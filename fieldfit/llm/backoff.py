"""Language-model scores by stupid backoff, computed relationally.

Words are the tokens of a public tokenizer, so the tables of single tokens are
bounded by its vocabulary. Documents are tokenised once, in blocks of a bounded
number of tokens. The n-grams of a block are counted before they are exploded, so
that a frequent one is a single row per block; the count tables over all documents,
partitioned by the hash of the n-gram, are joined to these rows, and the result
comes back to the block, where the logarithms are summed per document.

A document is scored against the rest of the corpus: its own n-grams are taken off
every count first. With these counts, S(w | h) is count(h w) / count(h) if that is
above zero and otherwise BACKOFF times S(w | h without its first token); at the end
stands count(w) / total, with one in place of a count of zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldfit.llm.common import stored
from fieldfit.llm.packing import encoder

ORDER = 2
BACKOFF = 0.4
ID_BITS = 16
BLOCK_TOKENS = 3_000_000
SLICE_TOKENS = 500_000  # of a block, scored at once
BEGIN = (1 << ID_BITS) - 1  # stands before the first token; no token has this id


def grams_of(documents: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at every token (its last token in the lowest bits), and the token's document."""
    sizes = np.array([len(d) for d in documents], np.int64)
    gap = np.full(order - 1, BEGIN, np.int64)
    padded = np.concatenate([x for d in documents for x in (gap, d.astype(np.int64))] or [gap])
    where = np.repeat(np.arange(len(documents)), sizes)
    ends = np.arange(sizes.sum()) + (where + 1) * (order - 1)
    gram = np.zeros(len(ends), np.int64)
    for j in range(order - 1, -1, -1):
        gram = gram << ID_BITS | padded[ends - j]
    return gram, where


def tokenised(docs: DataFrame, key: str, text: str, tokenizer: str, order: int) -> DataFrame:
    """Per row of ``docs`` its block and token ids; per block one row more (NULL ``_row``)
    with its distinct n-grams and how often each occurs."""
    kind = docs.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("_key", kind),
            T.StructField("_row", T.LongType()),
            T.StructField("block", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("grams", T.ArrayType(T.LongType())),
            T.StructField("times", T.ArrayType(T.LongType())),
        ]
    )

    def block(batch: pa.RecordBatch, documents: list[np.ndarray]) -> pa.RecordBatch:
        n, name = len(documents), batch["_row"][0].as_py()
        gram, times = np.unique(grams_of(documents, order)[0], return_counts=True)
        columns = [
            pa.concat_arrays([batch["_key"], pa.nulls(1, batch["_key"].type)]),
            pa.concat_arrays([batch["_row"], pa.nulls(1, pa.int64())]),
            pa.array(np.full(n + 1, name)),
            pa.array([d.astype("<u2").tobytes() for d in documents] + [None], pa.binary()),
            pa.array([None] * n + [gram], pa.list_(pa.int64())),
            pa.array([None] * n + [times], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(public_tokenizers.path(tokenizer)).encode_all
        for batch in batches:
            at, documents, tokens = 0, [], 0
            for i, raw in enumerate(encode_all(batch["_text"])):
                documents.append(np.frombuffer(raw, "<u4"))
                tokens += len(documents[-1])
                if tokens >= BLOCK_TOKENS or i == len(batch) - 1:
                    yield block(batch.slice(at, len(documents)), documents)
                    at, documents, tokens = i + 1, [], 0

    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.monotonically_increasing_id().alias("_row"), F.col(f"`{text}`").alias("_text"))
    return rows.mapInArrow(run, schema)


def count_tables(exploded: DataFrame, order: int) -> dict[int, DataFrame]:
    """(``gram``, ``count``) for every order, over all documents."""
    tables = {order: stored(exploded.groupBy("gram").agg(F.sum("times").alias("count")), f"counts-{order}")}
    for n in range(order - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << ID_BITS * n) - 1))
        tables[n] = stored(tables[n + 1].groupBy(shorter.alias("gram")).agg(F.sum("count").alias("count")), f"counts-{n}")
    return tables


def with_counts(exploded: DataFrame, tables: dict[int, DataFrame], order: int) -> DataFrame:
    """(``block``, ``gram``) with the counts over all documents of every order:
    of the n-gram's last n tokens (``all{n}``) and of their history (``history{n}``)."""
    rows = exploded.select("block", "gram")
    for n in range(order, 1, -1):
        level = F.col("gram").bitwiseAND(F.lit((1 << ID_BITS * n) - 1))
        history = tables[n].groupBy(F.shiftright("gram", ID_BITS).alias("_h")).agg(F.sum("count").alias(f"history{n}"))
        # histories of one token are bounded by the vocabulary
        history = F.broadcast(history) if n == 2 else stored(history, f"histories-{n}")
        counts = tables[n].select(F.col("gram").alias("_g"), F.col("count").alias(f"all{n}"))
        rows = rows.withColumn("_g", level).join(counts, "_g").withColumn("_h", F.shiftright("_g", ID_BITS)).join(history, "_h").drop("_g", "_h")
    single = F.broadcast(tables[1].select(F.col("gram").alias("_g"), F.col("count").alias("all1")))  # vocabulary at most
    return rows.withColumn("_g", F.col("gram").bitwiseAND(F.lit((1 << ID_BITS) - 1))).join(single, "_g").drop("_g")


def log_scores(documents: list[np.ndarray], table: dict[str, np.ndarray], order: int, backoff: float, total: int) -> np.ndarray:
    """Sum of the logarithms of every document; ``table`` is sorted by ``gram``."""
    gram, where = grams_of(documents, order)
    if not len(gram):
        return np.zeros(len(documents))
    at = np.searchsorted(table["gram"], gram)
    packed = len(documents) >> (62 - ID_BITS * order) == 0  # document and n-gram fit one integer

    def own(part: np.ndarray) -> np.ndarray:
        if packed:
            pair = where << ID_BITS * order | part
        else:
            different, number = np.unique(part, return_inverse=True)
            pair = where * len(different) + number
        _, which, times = np.unique(pair, return_inverse=True, return_counts=True)
        return times[which]

    sizes = np.array([len(d) for d in documents])
    single = np.maximum(table["all1"][at] - own(gram & ((1 << ID_BITS) - 1)), 1)
    score = np.log(single / np.maximum(total - sizes[where], 1)) + (order - 1) * np.log(backoff)
    for n in range(2, order + 1):  # a longer n-gram that occurs elsewhere overrules the shorter ones
        part = gram & ((1 << ID_BITS * n) - 1)
        others = table[f"all{n}"][at] - own(part)
        seen = others > 0
        history = table[f"history{n}"][at] - own(part >> ID_BITS)
        score[seen] = np.log(others[seen] / history[seen]) + (order - n) * np.log(backoff)
    return np.bincount(where, score, len(documents))


def scores(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    order: int = ORDER,
    backoff: float = BACKOFF,
) -> DataFrame:
    """One row per row of ``docs``: key, ``n_tokens``, ``log_score``, ``mean_score``.

    ``log_score`` is the sum of the natural logarithms over the tokens and
    ``mean_score`` that sum per token.

    * NULL text counts as empty; without tokens the sum is 0 and the mean NULL.
    * A single document has no rest of the corpus: every count is taken as one at
      the end of the backoff.
    * NULL and repeated keys keep their rows; copies of a text count as other
      documents. Other columns may have any name; an empty table gives an empty
      result. ``order`` is from 2 to 3 (n-grams are packed into one integer).
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    blocks = stored(tokenised(docs, key, text, tokenizer, order), "token-blocks")
    exploded = (
        blocks.where("grams is not null")
        .select("block", F.explode(F.arrays_zip("grams", "times")).alias("x"))
        .select("block", F.col("x.grams").alias("gram"), F.col("x.times").alias("times"))
    )
    tables = count_tables(exploded, order)
    total = tables[1].agg(F.sum("count")).first()[0] or 0
    counts = with_counts(exploded, tables, order)
    columns = ["gram", "all1", *[f"{c}{n}" for n in range(2, order + 1) for c in ("all", "history")]]
    kind = docs.schema[key].dataType

    def score(held: pa.Table, known: pa.Table) -> pa.Table:
        table = {c: known[c].to_numpy() for c in columns}
        by_gram = np.argsort(table["gram"])
        table = {c: v[by_gram] for c, v in table.items()}
        documents = [np.frombuffer(x.as_py(), "<u2") for x in held["ids"]]
        sizes = np.array([len(d) for d in documents], np.int64)
        sums, at = [], 0
        while at < len(documents):
            upto = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), SLICE_TOKENS)))
            sums.append(log_scores(documents[at:upto], table, order, backoff, total))
            at = upto
        found = [pa.array(sizes), pa.array(np.concatenate(sums) if sums else np.zeros(0))]
        return pa.Table.from_arrays([held["_key"], *found], names=["_key", "n_tokens", "log_score"])

    shape = T.StructType([T.StructField("_key", kind), T.StructField("n_tokens", T.LongType()), T.StructField("log_score", T.DoubleType())])
    texts = blocks.where("_row is not null").select(F.col("block").alias("of"), "_key", "ids")
    scored = texts.groupBy("of").cogroup(counts.groupBy("block")).applyInArrow(score, shape)
    return scored.select(
        F.col("_key").alias(key), "n_tokens", "log_score", F.when(F.col("n_tokens") > 0, F.col("log_score") / F.col("n_tokens")).alias("mean_score")
    )
