"""Stupid backoff against a direct computation, leave-one-out, odd rows."""

import math
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF
from fieldfit.llm.backoff import grams_of, log_scores, scores


def brute(texts, order, alpha=0.4):
    """(tokens, log score) of every text against the others."""
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = [library.encode(t or "", add_special_tokens=False).ids for t in texts]

    def grams(ids, n):
        padded = ["^"] * (n - 1) + ids
        return Counter(tuple(padded[i : i + n]) for i in range(len(ids)))

    own = [{n: grams(d, n) for n in range(1, order + 1)} for d in docs]
    whole = {n: sum((o[n] for o in own), Counter()) for n in range(1, order + 1)}
    heads = lambda c: sum((Counter({g[:-1]: k}) for g, k in c.items()), Counter())
    whole_heads = {n: heads(whole[n]) for n in whole}
    total, out = sum(map(len, docs)), []
    for d, o in zip(docs, own):
        mine = {n: heads(o[n]) for n in o}
        sums = 0.0
        for g, k in o[order].items():
            factor = 1.0
            for n in range(order, 0, -1):
                part = g[-n:]
                rest = whole[n][part] - o[n][part]
                if n > 1 and rest > 0:
                    s = factor * rest / (whole_heads[n][part[:-1]] - mine[n][part[:-1]])
                    break
                if n == 1:
                    s = factor * max(rest, 1) / max(total - len(d), 1)
                factor *= alpha
            sums += k * math.log(s)
        out.append((len(d), sums))
    return out


@pytest.mark.parametrize("order", [2, 3])
def test_small_corpus(spark, order):
    texts = ["the cat sat on the mat", "the dog sat on the cat", None, "", "zebra", "the cat sat on the mat", "a b a b a b a b", "the " * 3000]
    rows = [(i if i != 4 else None, t, 5) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, gram int")
    got = {r.doc_id: (r.n_tokens, r.log_score, r.mean_score) for r in scores(df, order=order).collect()}
    for (i, _, _), (n, s) in zip(rows, brute(texts, order)):
        assert got[i][0] == n and got[i][1] == pytest.approx(s, abs=1e-6)
        assert got[i][2] == (pytest.approx(s / n, abs=1e-9) if n else None)
    if order == 2:
        assert scores(df.where("false")).count() == 0
        assert scores(df.where("doc_id = 0")).count() == 1


def test_whole_table(spark):
    from fieldfit.llm.queries import op9_stupid_backoff

    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = {r.doc_id: (r.n_tokens, r.log_score) for r in op9_stupid_backoff(spark, SF).collect()}
    want = brute([t for _, t in rows], 2)
    assert len(got) == len(rows)
    for (i, _), (n, s) in zip(rows, want):
        assert got[i][0] == n and got[i][1] == pytest.approx(s, rel=1e-9, abs=1e-6)


def test_order_3_tells_documents_apart_in_large_slices():
    one = np.array([5, 6, 7, 5, 6], "<u2")
    for n in (3, 65_537):
        documents = [one, *[np.array([9], "<u2")] * (n - 2), one]
        grams = np.unique(grams_of(documents, 3)[0])
        table = {c: np.full(len(grams), 1000) for c in ("all1", "all2", "all3", "history2", "history3")} | {"gram": grams}
        got = log_scores(documents, table, 3, 0.4, 10**6)
        assert got[0] == got[-1] and (got[1:-1] == got[1]).all()
        # copies must not share their own counts: the first document alone scores the same
        assert got[0] == log_scores([one], table, 3, 0.4, 10**6)[0]
