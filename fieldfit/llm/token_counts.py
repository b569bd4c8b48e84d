"""Token counts by a compiled finite-state tokenizer.

The tokenizer is a cascade: a pre-tokenizer that cuts a text into words, and a
byte-pair encoder. The encoder is compiled, transition by transition as they are
first taken, into a deterministic transducer whose transitions carry the change of
the token count (``bpe_lattice.CountTransducer``).

A text of over ``CHUNK_CHARS`` characters becomes chunk rows, which any task may
count. A chunk ends where the pre-tokenizer surely cuts, whatever stands around
that place, or inside a word too long for a chunk. Its state map says, for a state
of the transducer at its begin, the state at its end and the tokens in between.
After a sure cut the begin is the start state; inside a word it is first guessed
from the characters before the chunk. A prefix scan over a text's chunks composes
the maps: where the state that one chunk ends in is not the one that the next was
read from, the map of the next gets that state too, until all of them fit.
"""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldfit.llm.bpe_lattice import START, CountTransducer, Lattice
from fieldfit.llm.common import stored

LIMIT = 512
CHUNK_CHARS = 1 << 16
CONTEXT_CHARS = 512  # characters before a chunk from which its first state is guessed
CACHED_PIECES = 250_000

# Ends of words, whatever follows or comes before. An apostrophe may begin a short form.
SURE = regex.compile(r"\S(?=\s)|\p{L}(?=[^\s\p{L}])|\p{N}(?=[^\s\p{N}])|[^\s\p{L}\p{N}'](?=[\p{L}\p{N}])")
# Eight characters of one kind: between the middle ones there is never an end of a word.
INSIDE = regex.compile(r"\p{L}{8}|\p{N}{8}|[^\s\p{L}\p{N}]{8}|\s{8}")

# Unicode white space, as the pre-tokenizer's \s has it.
SPACE = "\\t-\\r \x85\xa0  -     　"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Counter:
    """Counts the tokens of texts as the tokenizer file says."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda t: bytes(letters[c] for c in t)
        ranks = {}
        for i, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            ranks[raw(a), raw(b)] = i
        special = [t["content"] for t in spec["added_tokens"]]
        tokens = [raw(t) for t in spec["model"]["vocab"] if t not in special]
        self.transducer = CountTransducer(Lattice(tokens, ranks.get))
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.words = regex.compile(public_tokenizers.PATTERN).findall
        # white space and the run after it: ends where the pre-tokenizer surely cuts
        self.pieces = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
        self.known: dict[str, int] = {}
        self.known_words: dict[str, int] = {}

    def piece(self, piece: str) -> int:
        """Tokens of a text between two sure cuts."""
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= CACHED_PIECES:
                self.known.clear()
            n = sum(map(self.word, self.words(piece)))
            if len(piece) <= 64:
                self.known[piece] = n
        return n

    def word(self, word: str) -> int:
        """Tokens of one word of the pre-tokenizer."""
        n = self.known_words.get(word)
        if n is None:
            if len(self.known_words) >= CACHED_PIECES:
                self.known_words.clear()
            n = self.transducer.count(word.encode())
            if len(word) <= 64:
                self.known_words[word] = n
        return n

    def chunk_map(self, chunk: str) -> tuple[str, int, str | None]:
        """(head, count, tail); a chunk without a sure cut is a head alone."""
        pieces = self.pieces(chunk)
        if len(pieces) < 2:
            return chunk, 0, None
        known, head, tail = self.known, pieces[0], pieces[-1]
        inner = [known.get(p) for p in pieces[1:-1]]
        if None in inner:
            inner = [self.piece(p) if n is None else n for p, n in zip(pieces[1:-1], inner)]
        return head, sum(inner), tail

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two adjacent stretches of text."""
        head, n, tail = self.chunk_map((a[0] if a[2] is None else a[2]) + b[0])
        if a[2] is not None:  # what meets in between starts at a sure cut
            if tail is None and b[2] is None:
                return a[0], a[1], head
            n, head, left = a[1] + self.piece(head) + n, a[0], a[0]
            if tail is None:
                return left, n + b[1], b[2]
            if b[2] is None:
                return left, n, tail
            return left, n + self.piece(tail) + b[1], b[2]
        if tail is None:
            return head, b[1], b[2]
        if b[2] is None:
            return head, n, tail
        return head, n + self.piece(tail) + b[1], b[2]

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if not text:
            return 0
        maps = [self.chunk_map(text[i : i + CHUNK_CHARS]) for i in range(0, len(text), CHUNK_CHARS)]
        while len(maps) > 1:
            pairs = [self.compose(maps[i], maps[i + 1]) for i in range(0, len(maps) - 1, 2)]
            maps = pairs + maps[len(pairs) * 2 :]
        head, n, tail = maps[0]
        return self.piece(head) + n + (self.piece(tail) if tail is not None else 0)

    def chunks(self, text: str, size: int = CHUNK_CHARS, before: int = CONTEXT_CHARS) -> Iterator[tuple[str, str | None, bool]]:
        """(chunk, characters before it if it begins inside a word, whether it ends inside one)."""
        for part in self.special.split(text) if self.special else [text]:
            at, context = 0, None
            while len(part) - at > 2 * size:
                low, high = at + size, at + 2 * size
                sure = SURE.search(part, low, high)
                # without a sure cut there are at most three kinds of characters, one after another
                cut = sure.end() if sure else INSIDE.search(part, low, high).start() + 4
                yield part[at:cut], context, not sure
                context = None if sure else part[max(at, cut - before) : cut]
                at = cut
            yield part[at:], context, False

    def guess(self, context: str | None) -> tuple:
        """A likely state after ``context``, the end of an unfinished stretch."""
        return START if context is None else self.transducer.run(START, self.words(context)[-1].encode())[0]

    def state_map(self, entry: tuple, chunk: str, unfinished: bool) -> tuple[tuple, int]:
        """The state at the chunk's end and its tokens, read from state ``entry``."""
        words, total, state = self.words(chunk), 0, START
        if words and entry != START:
            state, total = self.transducer.run(entry, words[0].encode())
            words = words[1:]
        if words:
            last = words.pop() if unfinished else None
            total += sum(map(self.word, words))
            if last is not None:
                state, change = self.transducer.run(START, last.encode())
                total += change
        return state if unfinished else START, total

    def count(self, text: str | None) -> int:
        """Tokens of a text; a special string in it is one token."""
        if not text:
            return 0
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(map(self.plain, parts))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One compiled tokenizer per worker process."""
    return Counter(path)


def token_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    limit: int = LIMIT,
    chunk_chars: int = CHUNK_CHARS,
    context_chars: int = CONTEXT_CHARS,
) -> DataFrame:
    """One row per row of ``docs``: key, ``n_bytes``, ``n_tokens``, ``over_limit``.

    * ``tokenizer`` names a byte-level file of the public tokenizers, which every
      executor has; counts are those of its library without added begin or end tokens.
    * NULL text counts as empty: no bytes, no tokens. NULL and repeated keys keep
      their rows; other columns may have any name; an empty table gives an empty
      result. Texts of over ``chunk_chars`` characters (32 at least) are counted
      in chunk rows of at most twice that.
    """
    kind = docs.schema[key].dataType.simpleString()
    shape = f"_key {kind}, n_bytes bigint, _row bigint, nth int, n_tokens bigint, chunk string, context string, unfinished boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(public_tokenizers.path(tokenizer))

        def pack(batch: pa.RecordBatch, which: list[int], out: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
            columns = [batch[c].take(pa.array(which, pa.int64())) for c in ("_key", "n_bytes", "_row")]
            columns += [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            return pa.RecordBatch.from_arrays(columns, ["_key", "n_bytes", "_row", "nth", "n_tokens", "chunk", "context", "unfinished"])

        for batch in batches:
            which, out = [], []
            for at, value in enumerate(batch["_text"]):
                text = value.as_py()
                if text is None or len(text) <= chunk_chars:
                    which.append(at)
                    out.append((0, tool.count(text), None, None, False))
                    continue
                specials = len(tool.special.findall(text)) if tool.special else 0
                for nth, (chunk, context, unfinished) in enumerate(tool.chunks(text, chunk_chars, context_chars)):
                    which.append(at)
                    out.append((nth, 0 if nth else specials, chunk, context, unfinished))
                    if nth % 100 == 99:
                        yield pack(batch, which, out)
                        which, out = [], []
            if out:
                yield pack(batch, which, out)

    rows = docs.select(
        F.col(f"`{key}`").alias("_key"),
        F.octet_length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("bigint").alias("n_bytes"),
        F.col(f"`{text}`").alias("_text"),
    )
    cut = stored(rows.withColumn("_row", F.monotonically_increasing_id()).mapInArrow(run, shape), "token-chunks")
    long = cut.where(F.col("chunk").isNotNull())
    counted = cut.where(F.col("chunk").isNull()).select("_key", "n_bytes", "n_tokens")
    if not long.isEmpty():
        inside = composed(long, tokenizer).groupBy("_row").agg(F.sum("n").alias("_inside"))
        whole = long.where("nth = 0").select("_row", "_key", "n_bytes", "n_tokens").join(inside, "_row")
        counted = counted.unionByName(whole.select("_key", "n_bytes", (F.col("n_tokens") + F.col("_inside")).alias("n_tokens")))
    return counted.select(F.col("_key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def state_maps(chunks: DataFrame, tokenizer: str) -> DataFrame:
    """(``_row``, ``nth``, ``entry``, ``leaves``, ``n``) of chunk rows; a NULL ``entry`` is guessed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(public_tokenizers.path(tokenizer))
        for batch in batches:
            out = []
            for chunk, context, unfinished, entry in zip(*[batch[c].to_pylist() for c in ("chunk", "context", "unfinished", "entry")]):
                state = tool.guess(context) if entry is None else ast.literal_eval(entry)
                leaves, n = tool.state_map(state, chunk, unfinished)
                out.append((repr(state), repr(leaves), n))
            entry, leaves, n = zip(*out) if out else ((), (), ())
            columns = [batch["_row"], batch["nth"], pa.array(entry, pa.string()), pa.array(leaves, pa.string()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["_row", "nth", "entry", "leaves", "n"])

    return chunks.select("_row", "nth", "chunk", "context", "unfinished", "entry").mapInArrow(
        run, "_row bigint, nth int, entry string, leaves string, n bigint"
    )


def composed(long: DataFrame, tokenizer: str) -> DataFrame:
    """State maps of the chunks of every text, each read from the state that the one before ends in.

    A guess is wrong only while the states after different begins of a word stay
    apart, as in a long run of one letter; every round reads such chunks again from
    the state found, and sets at least one more chunk of every such text right.
    """
    first = long.withColumn("entry", F.lit(None).cast("string")).repartition("_row", "nth")
    maps = stored(state_maps(first, tokenizer), "state-maps")
    in_text = Window.partitionBy("_row").orderBy("nth")  # at most 32,768 chunks: a text is no longer than 2^31 bytes
    while True:
        came = maps.withColumn("came", F.lag("leaves", 1, repr(START)).over(in_text))
        wrong = stored(came.where("came <> entry").select("_row", "nth", F.col("came").alias("entry")), "wrong-states")
        if wrong.isEmpty():
            return maps
        again = state_maps(long.join(wrong, ["_row", "nth"]).repartition("_row", "nth"), tokenizer)
        maps = stored(maps.join(wrong.select("_row", "nth"), ["_row", "nth"], "left_anti").unionByName(again), "state-maps")
