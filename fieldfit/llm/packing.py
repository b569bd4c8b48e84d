"""Packing tokenised documents into sequences of a fixed size.

One pass tokenises every text and writes its pieces (lengths and digests) to the
shared folder. The number of pieces per length, at most one count per token of a
sequence, goes to the driver, where bin completion turns it into patterns. The
patterns come back as ranges of piece numbers per length, whose size is bounded by
the sequence size and not by the data, and every piece finds its place by its
number among the pieces of its length. Numbers are given inside slices of bounded
size, so a length that a third of all documents share is no task's burden.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from fieldfit.llm.bin_completion import Pattern, pack
from fieldfit.llm.common import stored

SIZE = 4096
END_ID = 1
SLICE_ROWS = 1_000
CACHED_WORDS = 300_000
CACHED_CHARS = 8_000_000
BATCH_CHARS = 8_000_000


# Letters that are in composed form whatever the normaliser does, and marks: the
# pre-tokenizer cuts a word between the two (an apostrophe may go either way).
LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class Kept:
    """Ids of words met lately, and of those met before them: bounded in words and letters."""

    def __init__(self, encode: Callable[[list[str]], Iterator[bytes]]):
        self.encode = encode
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.chars = 0

    def ids(self, words: list[str]) -> list[bytes]:
        """Ids of every word, no word given twice. A call's own words are kept, however many."""
        fresh = [w for w in words if w not in self.now]
        if fresh:
            if len(self.now) + len(fresh) > CACHED_WORDS or self.chars + sum(map(len, fresh)) > CACHED_CHARS:
                self.before, self.now, self.chars, fresh = self.now, {}, 0, words
            self.chars += sum(map(len, fresh))
            again = [w for w in fresh if w in self.before]
            self.now.update(zip(again, map(self.before.__getitem__, again)))
            fresh = [w for w in fresh if w not in self.before]
            self.now.update(zip(fresh, self.encode(fresh)))
        return list(map(self.now.__getitem__, words))


class Encoder:
    """Ids of texts by a tokenizer whose words never cross blanks.

    Every different run without a blank is looked up once per batch; a text's ids
    are those of its runs in order. A run of plain letters with marks behind it is
    cut between them and its letters are looked up in lower case, so that few
    different ones remain for the library to encode.
    """

    def __init__(self, path: str):
        self.full = Tokenizer.from_file(path)
        # The same model for words already in lower case: cut at blanks alone.
        self.light = Tokenizer.from_file(path)
        self.light.normalizer = normalizers.Sequence([])
        self.light.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.ends = np.zeros(max(self.full.get_vocab().values()) + 1, bool)
        self.ends[[i for t, i in self.full.get_vocab().items() if t.endswith("</w>")]] = True
        self.any_words, self.low_words = Kept(self.encode_any), Kept(self.encode_low)

    known = property(lambda self: self.any_words.now)
    known_before = property(lambda self: self.any_words.before)
    letters = property(lambda self: self.low_words.now)
    letters_before = property(lambda self: self.low_words.before)

    def learn(self, words: list[str]) -> list[bytes]:
        return self.any_words.ids(words)

    def learn_letters(self, words: list[str]) -> list[bytes]:
        return self.low_words.ids(words)

    def encode_any(self, words: list[str]) -> Iterator[bytes]:
        for part in parts_of(words):
            starts = np.array([0, *accumulate(len(w) + 1 for w in part)])
            done = self.full.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(done.ids, "<u4")
            where = np.fromiter((o[0] for o in done.offsets), np.int64, len(ids))
            yield from split_at(ids, np.searchsorted(where, starts))

    def encode_low(self, words: list[str]) -> Iterator[bytes]:
        for part in parts_of(words):
            ids = np.array(self.light.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            yield from split_at(ids, np.concatenate(([0], np.flatnonzero(self.ends[ids]) + 1)))

    def encode_batch(self, texts: pa.Array) -> Iterator[bytes]:
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.values.dictionary_encode()
        words = coded.dictionary
        # A word is two parts: its letters and its marks, or the whole and nothing.
        letters = pc.utf8_rtrim(words, MARKS)
        plain = pc.match_substring_regex(letters, f"^{LETTERS}$")
        low = pc.utf8_lower(letters.filter(plain)).dictionary_encode()
        marks = pc.replace_substring_regex(words.filter(plain), f"^{LETTERS}", "").dictionary_encode()
        other = words.filter(pc.invert(plain)).to_pylist()
        # marks may themselves stand as words
        whole = list(dict.fromkeys([*other, *marks.dictionary.to_pylist()]))
        at = {w: n for n, w in enumerate(whole)}
        shift = np.array([at[m] for m in marks.dictionary.to_pylist()], np.int64)
        raw = [*self.learn(whole), *self.learn_letters(low.dictionary.to_pylist()), b""]
        which = plain.to_numpy(zero_copy_only=False)
        parts = np.full((len(words), 2), len(raw) - 1)
        parts[~which, 0] = [at[w] for w in other]
        parts[which, 0] = low.indices.to_numpy() + len(whole)
        parts[which, 1] = shift[marks.indices.to_numpy()]
        # The ids of the parts of all words of all texts, one after the other.
        table = np.frombuffer(b"".join(raw), "<u4")
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        starts = np.cumsum(sizes) - sizes
        placed = parts[coded.indices.to_numpy()].ravel()
        ends = np.cumsum(sizes[placed])
        ids = table[np.repeat(starts[placed] - ends + sizes[placed], sizes[placed]) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate(([0], ends))[2 * split.offsets.to_numpy()].tolist()
        for a, b in zip(cuts, cuts[1:]):
            yield ids[a:b].tobytes()

    def encode_all(self, texts: list[str | None] | pa.Array) -> Iterator[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers; none for NULL."""
        rows = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
        upto = np.cumsum(pc.utf8_length(rows).to_numpy())
        at = 0
        while at < len(rows):
            end = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BATCH_CHARS, side="right"))
            end = max(end, at + 1)  # a longer text is a batch of its own
            collecting = gc.isenabled()
            gc.disable()  # many small objects, none of them in cycles
            try:
                done = list(self.encode_batch(rows.slice(at, end - at)))
            finally:
                if collecting:
                    gc.enable()
            yield from done
            at = end


def parts_of(words: list[str]) -> Iterator[list[str]]:
    return (words[at : at + 500] for at in range(0, len(words), 500))


def split_at(ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    raw, cuts = ids.tobytes(), (4 * cuts).tolist()
    return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One tokenizer per worker process."""
    return Encoder(path)


def pieces(docs: DataFrame, key: str, text: str, tokenizer: str, size: int, end_id: int) -> DataFrame:
    """(key, ``piece``, ``start``, ``length``, ``ids_crc32``) of every piece of every row."""
    kind = docs.schema[key].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(public_tokenizers.path(tokenizer)).encode_all
        for batch in batches:
            which, out = [], []
            for row, ids in enumerate(encode_all(batch["_text"])):
                ids += end
                for nth, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    which.append(row)
                    out.append((nth, at // 4, len(part) // 4, zlib.crc32(part)))
            if out:
                piece, *rest = zip(*out)
                columns = [batch["_key"].take(pa.array(which)), pa.array(piece, pa.int32()), *[pa.array(c, pa.int64()) for c in rest]]
                yield pa.RecordBatch.from_arrays(columns, ["_key", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    return rows.mapInArrow(run, f"_key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def places(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """(length, first number, documents per sequence, first sequence, offset) of every pattern part."""
    out, numbered, sequence = [], {}, 0
    for n, fill in patterns:
        offset = 0
        for length, per in fill:
            first = numbered.get(length, 0)
            out.append((length, first, per, sequence, offset))
            numbered[length] = first + n * per
            offset += length * per
        sequence += n
    return sorted(out)


def pack_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    size: int = SIZE,
    end_id: int = END_ID,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per piece: key, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    * A document is its ids and the end id; only one longer than ``size`` is cut,
      into pieces of ``size`` of which the last may be shorter. NULL text is empty:
      a document of the end id alone.
    * NULL and repeated keys keep their rows; other columns may have any name; an
      empty table gives an empty result.
    * ``tokenizer`` names a file of the public tokenizers whose words never cross
      blanks.
    """
    spark = docs.sparkSession
    cut = stored(
        pieces(docs, key, text, tokenizer, size, end_id).withColumn("_row", F.monotonically_increasing_id()), "pieces"
    )
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # size rows at most
    parts = places(pack(counts, size))
    many = F.broadcast(spark.createDataFrame(list(counts.items()), "length bigint, _n bigint"))  # size rows at most
    sliced = cut.join(many, "length").withColumn(
        "_slice", F.pmod(F.xxhash64("_row"), F.ceil(F.col("_n") / slice_rows)).cast("bigint")
    )
    in_slice = Window.partitionBy("length", "_slice").orderBy("_row")
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy("length", "_slice").agg(F.count(F.lit(1)).alias("_rows"))
        .select("length", "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    )
    numbered = sliced.withColumn("_nth", F.row_number().over(in_slice) - 1).join(starts, ["length", "_slice"])
    numbered = numbered.select("_key", "piece", "start", "length", "ids_crc32", (F.col("_nth") + F.col("_first")).alias("_number"))

    table = np.array(parts, np.int64).reshape(-1, 5)
    known = table[:, 0] << 44 | table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch["length"].to_numpy(), batch["_number"].to_numpy()
            at = table[np.searchsorted(known, length << 44 | number, side="right") - 1]
            nth = number - at[:, 1]
            found = [pa.array(at[:, 3] + nth // at[:, 2]), pa.array(at[:, 4] + nth % at[:, 2] * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], [*batch.schema.names[:-1], "sequence_id", "offset"])

    kind = docs.schema[key].dataType.simpleString()
    placed = numbered.mapInArrow(
        place, f"_key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )
    return placed.withColumnRenamed("_key", key)
