"""Token counts against the library: random and sample texts, chunk borders, specials."""

import random

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF
from fieldfit.llm import token_counts
from fieldfit.llm.token_counts import counter

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0  ​  　﻿ab12'sx.,-́é\U0001f600ⅷ²Ω中<|>"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(n, seed=1):
    rng = random.Random(seed)
    for k in range(n):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40)))
        yield text[:7] + "<|endoftext|>" + text[7:] if k % 5 == 0 else text


def test_counts_of_random_texts(library):
    for text in random_texts(3000):
        assert counter(PATH).count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


@pytest.mark.parametrize("size", [1, 2, 7])
def test_chunk_maps_compose_to_the_whole(monkeypatch, library, size):
    monkeypatch.setattr(token_counts, "CHUNK_CHARS", size)
    for text in random_texts(400, seed=size):
        assert counter(PATH).count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_composition_is_associative():
    c = counter(PATH)
    rng = random.Random(4)
    for _ in range(300):
        a, b, d = (c.chunk_map("".join(rng.choice("ab .\n") for _ in range(rng.randint(1, 6)))) for _ in range(3))
        assert c.compose(c.compose(a, b), d) == c.compose(a, c.compose(b, d))


def test_transducer_restarts_within_its_bound():
    c = token_counts.Counter(PATH)
    c.transducer.most = 5
    assert [c.transducer.count(w) for w in (b" tokenization", b" zzzzqqq", b" tokenization")] == [
        counter(PATH).transducer.count(w) for w in (b" tokenization", b" zzzzqqq", b" tokenization")
    ]


def test_whole_table(spark, library):
    from fieldfit.llm.queries import op5_token_transducer

    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op5_token_transducer(spark, SF).collect()}
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall()
    n = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows}
    assert got == {i: (len(t.encode()), n[i], n[i] > 512) for i, t in rows}


def test_odd_rows(spark):
    rows = [(1, None, 1), (None, "", 2), (1, "a" * 300_000, 3), (1, "a b", 4), (1, "a b", 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    out = token_counts.token_counts(df)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted((r.n_bytes, r.over_limit) for r in out.collect()) == [(0, False), (0, False), (3, False), (3, False), (300_000, True)]
    assert token_counts.token_counts(df.where("false")).count() == 0


def long_texts(seed):
    rng = random.Random(seed)
    for k in range(120):
        text = "".join(rng.choice(ALPHABET) * rng.choice([1, 1, 1, 2, 9, 150]) for _ in range(rng.randint(1, 60)))
        yield text[:300] + "<|endoftext|>" + text[300:] if k % 5 == 0 else text
    yield "a" * 2000
    yield "".join(rng.choice("abcdefgh中文字é") for _ in range(3000))
    yield " " * 999 + "'re" * 300 + "!" * 700 + "'s" + "'" * 300 + "s"


@pytest.mark.parametrize("size", [32, 50])
def test_chunks_put_together_are_the_text(size):
    for text in long_texts(size):
        chunks = list(counter(PATH).chunks(text, size))
        assert "".join(c for c, _, _ in chunks) == text.replace("<|endoftext|>", "").replace("<|startoftext|>", "")
        assert all(len(c) <= 2 * size for c, _, _ in chunks)
        assert [context is not None for _, context, _ in chunks[1:]] == [unfinished for _, _, unfinished in chunks[:-1]]


@pytest.mark.parametrize("size", [32, 50])
def test_state_maps_compose_to_the_whole(library, size):
    c, inside = counter(PATH), 0
    for text in long_texts(size):
        state, total = token_counts.START, len(c.special.findall(text))
        for chunk, context, unfinished in c.chunks(text, size):
            inside += context is not None
            state, n = c.state_map(state, chunk, unfinished)
            total += n
        assert total == len(library.encode(text, add_special_tokens=False).ids), repr(text)
    assert inside > 100


def test_long_texts_in_chunk_rows(spark, library, monkeypatch):
    """Small chunks; a guess from one character is often wrong and is mended in rounds."""
    labels, real = [], token_counts.stored
    monkeypatch.setattr(token_counts, "stored", lambda df, label: labels.append(label) or real(df, label))
    texts = [*enumerate([*long_texts(3), "", None, "plain words"]), (None, "b" * 1500), (1, "a" * 3000)]
    df = spark.createDataFrame(texts, "doc_id int, text string").repartition(3)
    rows = token_counts.token_counts(df, chunk_chars=200, context_chars=1).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in texts]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_bytes, r.n_tokens)) for r in rows)
    assert labels.count("state-maps") > 1
