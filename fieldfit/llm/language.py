"""Language of documents by a conditional random field over their words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldfit.llm.crf import Model, Numbers, fit, numbered

# The classifier is fitted on this many texts per language at most, those with the
# lowest hash of the key; everything else covers all rows.
FIT_PER_LANGUAGE = 150
SLICE_CHARS = 12_000_000
UNKNOWN = "und"


def held_out(key: str) -> Column:
    """Whether a row is kept from learning: CRC-32 of the key's text modulo 5 is 0."""
    return F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = FIT_PER_LANGUAGE) -> Model:
    """Fit on a bounded sample: ``per_language`` labelled texts of every language, none held out."""
    lowest = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key", F.xxhash64("text"))
    rows = docs.where(~held_out(key)).select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")
    )
    sample = (
        rows.where("lang is not null and text rlike '\\\\p{L}'")
        .withColumn("nth", F.row_number().over(lowest))
        .where(F.col("nth") <= per_language)
        .select("lang", "text")
        .collect()
    )
    sample.sort(key=lambda r: (r["lang"], r["text"]))
    return fit([r["text"] for r in sample], [r["lang"] for r in sample])


def label(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of every text: the label with most of its words' marginals, and its share."""
    numbers = Numbers()
    sequences = numbered(texts, numbers)
    if not model.labels:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    sums = model.marginals(sequences, model.emissions(list(numbers))) if numbers else np.zeros((len(texts), len(model.labels)))
    sizes = np.array([len(s) for s in sequences])
    best = sums.argmax(axis=1)
    score = np.where(sizes > 0, sums.max(axis=1) / np.maximum(sizes, 1), 0.0)
    names = [model.labels[b] if n else UNKNOWN for b, n in zip(best, sizes)]
    return names, np.clip(score, 0.0, 1.0)


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of SLICE_CHARS characters at most, or of one text."""
    at = chars = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > at and chars + n > SLICE_CHARS:
            yield at, i
            at, chars = i, 0
        chars += n
    if at < len(texts):
        yield at, len(texts)


def predict(docs: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs``, all columns, with the predicted language and its score; a narrow pass."""
    out = T.StructType([*docs.schema.fields, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for a, b in slices(texts):
                names, scores = label(texts[a:b], model)
                found = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, *found], [*batch.schema.names, pred, score])

    return docs.mapInArrow(run, out)


def languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: key, ``held_out``, ``lang_pred``, ``score``.

    * A text is NULL or has no letters: ``und`` with score 0. Otherwise a language
      seen in training; if there is none, ``und`` too.
    * The prediction looks at the text alone. NULL and repeated keys keep their
      rows; a NULL key counts as the empty text for the held-out rule. Other
      columns may have any name; an empty table gives an empty result.
    """
    model = train(docs, key, text, lang)
    rows = docs.select(F.col(f"`{key}`").alias("_key"), held_out(key).alias("held_out"), F.col(f"`{text}`").alias("_text"))
    return predict(rows, model, "_text").select(F.col("_key").alias(key), "held_out", "lang_pred", "score")
