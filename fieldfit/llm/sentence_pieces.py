"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice of ``bpe_lattice`` has one best token per position: the one that may
follow the best token of the position where it begins. The encoder reads symbol by
symbol and keeps, for the positions that a longer token could still begin at, the
path of backpointers behind them. Whenever all those paths run through one
boundary, everything before it is settled and its ids are given out, so memory does
not grow with the text.

All paths meet at a boundary between two symbols that stand next to each other in no
token. No token has a blank mark behind another symbol; the other symbols fall into
classes, the connected ones of the symbols that tokens put side by side. A text thus
falls into stretches: blank marks with what follows in one class. Those met before are
looked up; short ones are settled at their end, long ones on the way.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldfit.llm.bpe_lattice import Lattice

MARK = "▁"  # stands for a blank
CACHED_STRETCHES = 250_000
SETTLE_EVERY = 64
REMEMBERED_STATES = 150_000
BATCH_CHARS = 2_000_000


def stretch_pattern(tokens: Iterable[str]) -> re.Pattern:
    """Blank marks with the symbols of one class behind them, or with a symbol that no
    token puts beside another."""
    root: dict[str, str] = {}

    def top(c: str) -> str:
        while root.setdefault(c, c) != c:
            root[c] = c = root[root[c]]
        return c

    for token in tokens:
        plain = token.lstrip(MARK)
        for a, b in zip(plain, plain[1:]):
            root[top(a)] = top(b)
    classes: dict[str, list[str]] = {}
    for c in root:
        classes.setdefault(top(c), []).append(c)
    sets = ["".join(map(re.escape, sorted(c))) for c in sorted(classes.values(), key=len, reverse=True)]
    runs = [f"{MARK}*[{s}]+" for s in sets]
    return re.compile("|".join([*runs, f"{MARK}*[^{MARK}{''.join(sets)}]", f"{MARK}+"]))


def little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


class Pieces:
    """Vocabulary of a model file with byte fallback, as the lattice needs it."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.scores = {p: -model.get_score(i) for p, i in self.ids.items()}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("a piece has a blank mark behind another symbol")
        self.stretches = stretch_pattern(self.ids).findall
        self.byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        # What each id stands for: a text in UTF-8, or one byte of one.
        self.texts = [b""] * size
        for p, i in self.ids.items():
            self.texts[i] = p.replace(MARK, " ").encode()
        for b, i in self.byte_ids.items():
            self.texts[i] = bytes([b])
        self.texts[model.unk_id()] = " ⁇ ".encode()
        self.is_byte = [False] * size
        for i in self.byte_ids.values():
            self.is_byte[i] = True
        get = self.scores.get
        self.lattice = Lattice([p for p in self.ids], lambda pair: get(pair[0] + pair[1]) if pair[0] and pair[1] else None)
        # Ids of stretches met lately, and of those met before them.
        self.known: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}
        self.forget()

    def forget(self) -> None:
        """Drop the remembered steps of the search."""
        # A state: per position that a longer token could begin at, the symbols
        # since and the token before; the present position last. Its steps by symbol:
        # (steps of the next state, its number, length and id of the token that ends
        # there, whether no other position stays open).
        self.states: list[tuple] = [(("", None),)]
        self.number = {self.states[0]: 0}
        self.steps: list[dict[str, tuple]] = [{}]

    def step(self, state: int, symbol: str) -> tuple:
        """Compile the step from a state over a symbol that is a token."""
        lattice, last, still = self.lattice, None, []
        tokens, prefixes = lattice.tokens, lattice.prefixes
        for since, before in self.states[state]:
            token = since + symbol
            if last is None and token in tokens and lattice.follows(before, token):
                last = token
            if token in prefixes:
                still.append((token, before))
        key = (*still, ("", last))
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        found = self.steps[state][symbol] = self.steps[to], to, len(last), self.ids[last], not still
        return found

    def stream(self, symbols: Iterator[str]) -> Iterator[list[int]]:
        """Ids of a stream of symbols, given out as soon as they are settled."""
        if len(self.states) > REMEMBERED_STATES:
            self.forget()
        state, steps = 0, self.steps[0]
        open_: list[tuple] = []  # the step into each position that is not settled: its backpointer
        for symbol in symbols:
            found = steps.get(symbol)
            if found is None:
                if symbol not in self.lattice.tokens:  # no piece: its bytes, and nothing reaches across
                    yield self.path(open_, len(open_))
                    yield [self.byte_ids[b] for b in symbol.encode("utf-8", "surrogatepass")]
                    state, steps, open_ = 0, self.steps[0], []
                    continue
                found = self.step(state, symbol)
            steps, state, _, token, alone = found
            open_.append(found)
            if alone:  # only this position is left
                yield [token] if len(open_) == 1 else self.path(open_, len(open_))
                open_ = []
            elif len(open_) % SETTLE_EVERY == 0:
                meet = self.meeting(open_, [len(open_) - len(since) for since, _ in self.states[state]])
                if meet:
                    yield self.path(open_, meet)
                    open_ = open_[meet:]
        yield self.path(open_, len(open_))

    def stretch(self, symbols: str) -> array:
        """Ids of a stretch that fits the window: nothing reaches across its end, where all paths meet."""
        if len(self.states) > REMEMBERED_STATES:
            self.forget()
        steps, open_ = self.steps[0], []
        for symbol in symbols:
            try:
                found = steps[symbol]
            except KeyError:
                if symbol not in self.lattice.tokens:
                    return array("I", chain.from_iterable(self.stream(symbols)))
                found = self.step(open_[-1][1] if open_ else 0, symbol)
            steps = found[0]
            open_.append(found)
        return array("I", self.path(open_, len(open_)))

    @staticmethod
    def path(open_: list[tuple], end: int) -> list[int]:
        """Ids of the tokens from the settled boundary to another one."""
        out = []
        while end > 0:
            _, _, length, token, _ = open_[end - 1]
            out.append(token)
            end -= length
        return out[::-1]

    @staticmethod
    def meeting(open_: list[tuple], ends: list[int]) -> int:
        """The last boundary that the paths to all ``ends`` run through."""
        ends = set(ends)
        while len(ends) > 1:
            last = max(ends)
            ends.remove(last)
            ends.add(last - open_[last - 1][2] if last > 0 else 0)
        return ends.pop()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        known, out = self.known, []
        for s in self.stretches(MARK + text.replace(" ", MARK)):
            ids = known.get(s)
            if ids is None:
                if len(s) <= SETTLE_EVERY:
                    ids = self.known_before.get(s)
                    if ids is None:
                        ids = little_endian(self.stretch(s))
                    if len(known) >= CACHED_STRETCHES:
                        self.known_before = known
                        known = self.known = {}
                    known[s] = ids
                else:
                    ids = little_endian(array("I", chain.from_iterable(self.stream(s))))
            out.append(ids)
        return b"".join(out)

    def decode(self, raw: bytes) -> str:
        """Text of ids; one blank at the beginning goes. Bytes that are no UTF-8 give U+FFFD each."""
        ids = np.frombuffer(raw, "<u4").tolist()
        joined = b"".join(map(self.texts.__getitem__, ids))
        try:
            text = joined.decode()
        except UnicodeDecodeError:
            text = "".join(self.repaired(ids))
        return text[1:] if text.startswith(" ") else text

    def repaired(self, ids: list[int]) -> Iterator[str]:
        at = 0
        while at < len(ids):
            if not self.is_byte[ids[at]]:
                yield self.texts[ids[at]].decode()
                at += 1
                continue
            end = at
            while end < len(ids) and self.is_byte[ids[end]]:
                end += 1
            run = b"".join(self.texts[i] for i in ids[at:end])
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        yield run[:n].decode()
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    yield "�"
                    n = 1
                run = run[n:]
            at = end


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One vocabulary per worker process."""
    return Pieces(path)


def encoded(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = "piece_bpe_32k.model") -> DataFrame:
    """One row per row of ``docs``: key and ``ids`` (array of integers).

    NULL and empty texts have no ids. NULL and repeated keys keep their rows; other
    columns may have any name; an empty table gives an empty result.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = pieces(public_tokenizers.path(model)).encode
        for batch in batches:
            for at, part in parts_of(batch):
                ids = [np.frombuffer(encode(t), "<u4").astype(np.int32) for t in part["_text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["_key"], pa.array(ids, pa.list_(pa.int32()))], ["_key", "ids"])

    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    return rows.mapInArrow(run, f"_key {kind}, ids array<int>").withColumnRenamed("_key", key)


def decoded(encodings: DataFrame, key: str = "doc_id", ids: str = "ids", model: str = "piece_bpe_32k.model") -> DataFrame:
    """One row per row of ``encodings``: key and ``text``; NULL ids give the empty text."""
    kind = encodings.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = pieces(public_tokenizers.path(model)).decode
        for batch in batches:
            texts = [decode(np.array(x.as_py() or [], "<u4").tobytes()) for x in batch["_ids"]]
            yield pa.RecordBatch.from_arrays([batch["_key"], pa.array(texts, pa.string())], ["_key", "text"])

    rows = encodings.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{ids}`").alias("_ids"))
    return rows.mapInArrow(run, f"_key {kind}, text string").withColumnRenamed("_key", key)


def parts_of(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of a batch with BATCH_CHARS bytes of text at most, or one row."""
    sizes, at, size = pa.compute.binary_length(batch["_text"]).to_pylist(), 0, 0
    for i, n in enumerate(sizes):
        if i > at and size + (n or 0) > BATCH_CHARS:
            yield at, batch.slice(at, i - at)
            at, size = i, 0
        size += n or 0
    if at < len(sizes):
        yield at, batch.slice(at)


def round_trips(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = "piece_bpe_32k.model") -> DataFrame:
    """One row per row of ``docs``: key, ``n_ids``, ``ids_crc32``, ``decoded_sha256``, ``same``.

    The text is encoded and its ids are decoded in one pass. ``ids_crc32`` is over
    the ids as little-endian unsigned 32-bit integers; ``same`` tells whether the
    decoded text is the text (NULL counts as empty; a text with the blank mark
    itself decodes to blanks). NULL and repeated keys keep their rows; other columns
    may have any name; an empty table gives an empty result.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(public_tokenizers.path(model))
        for batch in batches:
            for _, part in parts_of(batch):
                raw = [vocabulary.encode(t) for t in part["_text"].to_pylist()]
                columns = [
                    part["_key"],
                    pa.array([len(r) // 4 for r in raw], pa.int64()),
                    pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                    pa.array([vocabulary.decode(r) for r in raw], pa.string()),
                    part["_text"],
                ]
                yield pa.RecordBatch.from_arrays(columns, ["_key", "n_ids", "ids_crc32", "_decoded", "_text"])

    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    done = rows.mapInArrow(run, f"_key {kind}, n_ids bigint, ids_crc32 bigint, _decoded string, _text string")
    return done.select(
        F.col("_key").alias(key), "n_ids", "ids_crc32", F.sha2("_decoded", 256).alias("decoded_sha256"), (F.col("_decoded") == F.col("_text")).alias("same")
    )
