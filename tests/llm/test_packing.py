"""Packing: exact optimum on small cases, whole results against the library, odd rows."""

import gc
import random
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import fieldfit.llm.packing as packing
from conftest import SF
from fieldfit.llm.bin_completion import best_fit, fillings, lower_bound, pack, sequences
from fieldfit.llm.packing import Encoder, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def holds(patterns, counts, size):
    placed = Counter()
    for n, fill in patterns:
        assert n > 0 and sum(length * c for length, c in fill) <= size
        for length, c in fill:
            placed[length] += n * c
    assert placed == Counter({k: v for k, v in counts.items() if v})


def optimum(items, size):
    """Fewest sequences by trying everything."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(at, rests):
        if len(rests) >= best[0]:
            return
        if at == len(items):
            best[0] = len(rests)
            return
        for r in sorted(set(rests)):
            if r >= items[at]:
                rests.remove(r)
                go(at + 1, [*rests, r - items[at]])
                rests.append(r)
        go(at + 1, [*rests, size - items[at]])

    go(0, [])
    return best[0] if items else 0


def test_patterns_hold_everything_and_reach_the_optimum():
    rng = random.Random(2)
    for _ in range(150):
        size = rng.choice([10, 20, 50])
        items = [rng.randint(1, size) for _ in range(rng.randint(0, 9))]
        counts = Counter(items)
        got = pack(counts, size)
        holds(got, counts, size)
        assert sequences(got) == optimum(items, size)


def test_lower_bound_holds_and_is_met_early():
    rng = random.Random(6)
    for _ in range(300):
        size = rng.choice([7, 10, 20, 50])
        items = [rng.randint(1, size) for _ in range(rng.randint(0, 8))]
        assert -(-sum(items) // size) <= lower_bound(Counter(items), size) <= optimum(items, size)
    assert lower_bound({}, 10) == 0
    # two of these at most fit a sequence, one of those; total / size is far less
    assert lower_bound({1366: 2077}, 4096) == 1039
    assert lower_bound({2049: 50, 1000: 3}, 4096) == 50
    # best-fit meets the bound: no search
    counts = {length: 3 for length in range(1366, 2049)}
    started = time.perf_counter()
    assert sequences(pack(counts, 4096)) == lower_bound(counts, 4096) == 1025
    assert time.perf_counter() - started < 3


def test_encoder_keeps_bounded_text_and_the_collector(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_CHARS", 1000)
    library, e = Tokenizer.from_file(PATH), Encoder(PATH)
    rng = random.Random(7)
    for _ in range(40):
        text = " ".join("".join(rng.choice("abC9,é") for _ in range(rng.choice([3, 300]))) for _ in range(4))
        assert np.frombuffer(next(e.encode_all([text])), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert sum(map(len, e.known)) <= 2300 and sum(map(len, e.letters)) <= 2300
        assert sum(map(len, e.known_before)) <= 2300 and sum(map(len, e.letters_before)) <= 2300
    assert gc.isenabled()
    with pytest.raises(TypeError):
        e.learn_letters = None
        list(e.encode_all(["quite new words"]))
    assert gc.isenabled()


def test_completion_improves_on_best_fit():
    # best fit pairs the sixes with threes; three twos complete each six
    counts, size = {6: 4, 3: 8, 2: 12, 4: 4, 5: 4}, 12
    assert sequences(pack(counts, size)) <= sequences(best_fit(counts, size))
    holds(best_fit(counts, size), counts, size)


def test_many_documents_are_packed_by_their_counts():
    rng = random.Random(3)
    counts = {rng.randint(1, 4096): rng.randint(1, 10**7) for _ in range(1500)}
    got = pack(counts, 4096)
    holds(got, counts, 4096)
    total = sum(k * v for k, v in counts.items())
    assert sequences(got) <= 1.04 * total / 4096


def test_encoder_equals_library_and_restarts(monkeypatch):
    import fieldfit.llm.packing as packing

    library = Tokenizer.from_file(PATH)
    rng = random.Random(6)
    alphabet = "\t\n\x0b\x0c\r \x1c\x85\xa0   　ab12'sX.,-éÉ\U0001f600ⅷΣς中<|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a <|endoftext|> b", "x<|startoftext|>y", None, "", "don't we'LL"]
    want = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(Encoder(PATH).encode_all(texts)) == want
    monkeypatch.setattr(packing, "CACHED_WORDS", 50)
    monkeypatch.setattr(packing, "BATCH_CHARS", 100)
    assert list(Encoder(PATH).encode_all(texts)) == want


def check(rows, texts, size):
    """``rows`` are the pieces of ``texts`` ((key, text) pairs), packed without gaps."""
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for key, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for nth, at in enumerate(range(0, len(ids), size)):
            part = ids[at : at + size]
            want[key, nth, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values(), default=0) <= size
    return len(ends)


def test_whole_table(spark):
    from fieldfit.llm.queries import op6_bin_completion

    rows = op6_bin_completion(spark, SF).collect()
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    used = check(rows, texts, 4096)
    assert used <= -(-sum(r.length for r in rows) // 4096) + 1


@pytest.mark.parametrize("size", [4, 7])
def test_odd_rows(spark, size):
    texts = [(1, None), (None, ""), (1, "one two three four five six seven eight nine ten"), (1, "same"), (1, "same")] + [
        (i, "copy of one text") for i in range(2, 60)
    ]
    df = spark.createDataFrame([(i, t, 9, "x") for i, t in texts], "doc_id bigint, text string, length int, _row string")
    check(pack_documents(df, size=size, slice_rows=10).collect(), texts, size)
    assert pack_documents(df.where("false")).count() == 0


def test_completions_with_fewer_copies_than_fit():
    # 2000 + 1000 + 2 x 548 fills a sequence; two thousands or three 548s after the first do not
    for k in (1, 7, 1000):
        counts = {2000: 2 * k, 1000: 2 * k, 548: 4 * k}
        got = pack(counts, 4096)
        holds(got, counts, 4096)
        assert sequences(got) == 2 * k
        assert sequences(best_fit(counts, 4096)) > 2 * k


def test_fillings_are_all_undominated_ones():
    rng = random.Random(11)
    for _ in range(200):
        counts = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(4)}
        room, lengths = rng.randint(1, 30), sorted(counts)
        ways = {()}
        for length in reversed(lengths):
            ways = {(*w, n) for w in ways for n in range(counts[length] + 1)}
        want = set()
        for w in ways:
            rest = room - sum(n * x for n, x in zip(w, reversed(lengths)))
            if rest >= 0 and all(n == counts[x] or x > rest for n, x in zip(w, reversed(lengths))):
                want.add((rest, tuple((x, n) for n, x in zip(w, reversed(lengths)) if n)))
        assert set(fillings(lengths, counts, room, room, 1000, True)) == want
