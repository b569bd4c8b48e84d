"""SentencePiece: ids and texts against the library, streaming, odd rows."""

import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import fieldfit.llm.sentence_pieces as sp
from conftest import SF

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "   \n\tabcdeinrst.,'{}();\r0019éüßΩ中门\U0001f600▁­"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_random_texts(library):
    for t in texts(2500) + [" " * n for n in range(40)] + ["aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "   x", "in" * 100]:
        assert ids(sp.pieces(PATH).encode(t)) == library.encode(t), repr(t)
        assert sp.pieces(PATH).decode(sp.pieces(PATH).encode(t)) == library.decode(library.encode(t)), repr(t)


def test_no_piece_reaches_across_stretches():
    v = sp.pieces(PATH)
    assert [p for p in v.ids if len(v.stretches(p)) > 1] == []
    for t in texts(500, seed=8):
        assert "".join(v.stretches(t)) == t
    assert v.stretches("▁the!!\nAnd▁▁x▁") == ["▁the", "!!", "\n", "And", "▁▁x", "▁"]


def test_small_caches_change_nothing(monkeypatch, library):
    monkeypatch.setattr(sp, "CACHED_STRETCHES", 3)
    monkeypatch.setattr(sp, "REMEMBERED_STATES", 20)
    v = sp.Pieces(PATH)
    for t in texts(150, seed=9):
        assert ids(v.encode(t)) == library.encode(t), repr(t)
        assert len(v.known) <= 3 and len(v.known_before) <= 3


def test_decoding_of_any_ids(library):
    rng = random.Random(2)
    for _ in range(500):
        some = [rng.choice([rng.randint(0, 258), rng.randint(0, 31999)]) for _ in range(rng.randint(0, 12))]
        assert sp.pieces(PATH).decode(np.array(some, "<u4").tobytes()) == library.decode(some), some


def test_stream_gives_ids_out_early(monkeypatch, library):
    monkeypatch.setattr(sp, "SETTLE_EVERY", 4)
    fed = []

    def symbols():
        for c in ("▁the" + "▁cat" * 200):
            fed.append(c)
            yield c

    stream, out, lag = sp.pieces(PATH).stream(symbols()), [], 0
    for ids in stream:
        out += ids
        lag = max(lag, len(fed) - sum(len(library.id_to_piece(x)) for x in out))
    assert out == library.encode("the" + " cat" * 200)
    assert lag < 40
    for t in filter(None, texts(300, seed=5)):
        assert [i for ids in sp.pieces(PATH).stream(iter(sp.MARK + t.replace(" ", sp.MARK))) for i in ids] == library.encode(t)


def test_whole_table(spark, library):
    from fieldfit.llm.queries import op7_streaming_viterbi

    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall()
    got = {r.doc_id: (r.n_ids, r.ids_crc32, r.same) for r in op7_streaming_viterbi(spark, SF).collect()}
    want = {i: np.array(library.encode(t), "<u4") for i, t in rows}
    assert got == {i: (len(x), zlib.crc32(x.tobytes()), True) for i, x in want.items()}


def test_odd_rows(spark, library):
    rows = [(1, None, 1), (None, "", 2), (1, "a ▁b", 3), (1, "x" * 100_000, 4), (1, "same", 5), (1, "same", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    out = sp.round_trips(df).collect()
    assert sorted((r.n_ids, r.same) for r in out) == sorted((len(library.encode(t or "")), "▁" not in (t or "")) for _, t, _ in rows)
    both = sp.decoded(sp.encoded(df)).collect()
    assert sorted(r.text for r in both) == sorted((t or "").replace("▁", " ") for _, t, _ in rows)
    assert sp.round_trips(df.where("false")).count() == 0
