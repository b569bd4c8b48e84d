"""Spelling variants: neighbours and whole results against brute force, long words, odd rows."""

import random
import re
import zlib
from collections import Counter

from conftest import SF

from fieldfit.llm import spelling as sp
from fieldfit.llm.queries import QUERIES


def one_edit(u, v):
    if u == v or abs(len(u) - len(v)) > 1:
        return False
    if len(u) > len(v):
        u, v = v, u
    i = 0
    while i < len(u) and u[i] == v[i]:
        i += 1
    return u[i + 1 :] == v[i + 1 :] if len(u) == len(v) else u[i:] == v[i + 1 :]


def gapped(word):
    """Keys that two words one edit apart have in common."""
    return {(word[:i] + "*" + word[i + 1 :]) for i in range(len(word))} | {word[:i] + "*" + word[i:] for i in range(len(word) + 1)}


def brute_pairs(words):
    filed = {}
    for w in words:
        for k in gapped(w):
            filed.setdefault(k, []).append(w)
    return {(u, v) for same in filed.values() for u in same for v in same if one_edit(u, v)}


def brute_counts(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{w}".encode())
            if doc is not None and h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def brute_rows(counts):
    near, form = {w: [] for w in counts}, {}
    for u, v in brute_pairs(counts):
        near[u].append(v)
    for w, vs in near.items():
        top = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = top if top is not None and counts[top] >= 5 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()), key=repr)


def pairs_of(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(3)
    got = [tuple(r) for r in sp.neighbours(df).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_brute_force_keys_find_all_pairs():
    words = [a + b + c + d for a in "ab" for b in ("", "a", "b") for c in ("", "a", "b") for d in ("", "b")]
    words = sorted({w for w in words if len(w) > 1})
    assert brute_pairs(words) == {(u, v) for u in words for v in words if one_edit(u, v)}


def test_neighbours_among_crowded_words(spark):
    rng = random.Random(6)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(900)}
    words |= {w * 3 for w in list(words)[:40]} | {"aaaaaa", "aaaaaaa", "aaaaaaaa", "ab", "abc", "ÿÀ×÷"}
    assert pairs_of(spark, words) == brute_pairs(words)


def test_neighbours_of_long_words(spark):
    rng = random.Random(1)
    base = "".join(rng.choice("abcdefgh") for _ in range(3000))
    words = {base, base[:-1], base[1:], base + "a", "z" + base, base[:1500] + base[1501:], base[:100] + "Q" + base[101:], base[:2999] + "w", base[:40], base[:39], base[:33] + "q" + base[33:40]}
    assert pairs_of(spark, words) == brute_pairs(words)
    assert len(pairs_of(spark, {"x" * 200_000, "x" * 200_001, "x" * 200_000 + "y"})) == 6


def test_whole_result_on_odd_rows(spark):
    rng = random.Random(3)
    stems = ["".join(rng.choice("abcdeÀÿ") for _ in range(rng.randint(5, 9))) for _ in range(25)]
    rows = [(None, "lonely words without numbers " * 6), (1, None), (2, ""), (3, "123 -- ×÷×÷×÷ " * 9), (4, "ABCdef " * 50_000), (4, "İıſK " * 9)]
    for i in range(400):
        text = []
        for _ in range(40):
            w = rng.choice(stems)
            for _ in range(rng.choices([0, 1, 2], [20, 2, 1])[0]):
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "a", "ÿ", w[at] * 2]) + w[at + 1 :]
            text.append(rng.choice([w, w.upper()]))
        rows.append((i, rng.choice([" ", "\n", "1", "_"]).join(text)))
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id bigint, text string, word string, n int").repartition(4)
    got = sorted((tuple(r) for r in sp.report(df).collect()), key=repr)
    want = brute_rows(brute_counts(rows))
    assert got == want
    assert sum(r[1] is not None for r in want) > 10


def test_roots_of_chains_and_ties(spark):
    counts = {"letter": 700, "letters": 140, "lettets": 28, "lettet": 5, "lxttets": 5, "letterq": 700, "aletters": 28, "qqqqqq": 9}
    got = sorted((tuple(r) for r in sp.variants(spark.createDataFrame(list(counts.items()), "word string, n bigint")).collect()), key=repr)
    assert got == brute_rows(counts)
    assert next(r for r in got if r[0] == "lxttets")[1:3] == ("lettets", "letter")


def test_empty(spark):
    assert sp.report(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    one = sp.report(spark.createDataFrame([(0, "single " * 5)], "doc_id bigint, text string")).collect()
    assert [tuple(r) for r in one] == [("single", None, "single", 5, 0, None)]


def test_held_words_are_given_out_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sp, "HELD_WORDS", 3)
    rows = [(i, f"alphabet letters{'abcdefghij'[i % 10]} number{'klmnopqrst'[i % 10]}") for i in range(60)]
    got = sp.word_counts(spark.createDataFrame(rows, "doc_id bigint, text string"), plant=True).collect()
    assert {r.word: r.n for r in got} == brute_counts(rows)


def test_query_on_the_sample(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op13_trie_frontier"](spark, SF).collect()), key=repr)
    assert got == brute_rows(brute_counts(rows)) and len(got) > 50
