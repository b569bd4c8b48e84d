"""Nearest neighbours: recall and exact scores against brute force, probing, ties, odd rows."""

import duckdb
import numpy as np

from conftest import SF
from fieldfit.llm.mih import Block, distances, learn, neighbours


def brute(rows, every, nearest):
    """{query: [(vec_id, score), ...]} over (id, vector) rows."""
    out = {}
    for q, v in rows:
        if q % every == 0:
            near = sorted(((-float(np.dot(v, w)), i) for i, w in rows if i != q))[:nearest]
            out[q] = [(i, -s) for s, i in near]
    return out


def recall(got, want):
    hit = total = 0
    for q, near in want.items():
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, len(near) + 1))
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        hit += len({m[1] for m in mine} & {i for i, _ in near})
        total += len(near)
    return hit / max(1, total)


def test_probing_retrieves_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(800, 12))
    coder = learn(vectors, np.linalg.norm(vectors, axis=1).max(), bits=64)
    codes = coder.codes(vectors)
    block = Block(np.arange(800), vectors, codes)
    for radius in (0, 5, 8, 15, 23, 40, 64):
        for q in coder.codes(vectors[:20], query=True):
            assert block.probe(q, radius).tolist() == np.flatnonzero(distances(q, codes) <= radius).tolist()


def test_sample_table(spark):
    from fieldfit.llm.queries import op1_multi_index_hashing

    rows = [(i, np.array(v, np.float64)) for i, v in duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()]
    got = op1_multi_index_hashing(spark, SF).collect()
    want = brute(rows, 20, 20)
    assert recall(got, want) >= 0.9
    vectors = dict(rows)
    for r in got:
        assert abs(r.score - float(np.dot(vectors[r.query_id], vectors[r.vec_id]))) < 1e-12


def test_norms_matter_and_blocks_meet(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.1, 5)).tolist()) for i in range(300)]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id bigint, embedding array<double>, score double")
    got = neighbours(df, every=7, nearest=5, index_block=64, query_block=10).collect()
    assert recall(got, brute([(i, np.array(v)) for i, v in rows], 7, 5)) >= 0.9


def test_copies_ties_and_odd_rows(spark):
    rows = [(i, [1.0, 2.0]) for i in range(100, 160)] + [(i, [2.0, 1.0]) for i in range(160, 170)] + [(3, [5.0, 0.1])]
    odd = [(None, [1.0, 1.0]), (20, None), (40, [0.0, 0.0]), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]), (21, [None, 1.0]), (22, [1.0]), (100, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd], "vec_id bigint, embedding array<double>, ids string, rank int")
    got = neighbours(df).collect()
    want = brute([(i, np.array(v)) for i, v in rows], 20, 20)
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == {(q, n + 1, i, s) for q, near in want.items() for n, (i, s) in enumerate(near)}
    assert neighbours(df.where("false")).count() == 0
    one = neighbours(df.where("vec_id = 100")).count()
    assert one == 0


def test_vectors_of_any_size(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(40, 6)).tolist())]
    for odd in (1e200, 1e-200, 5e-324):
        mixed = [*rows, (100, [odd] + [0.0] * 5)]
        got = neighbours(spark.createDataFrame(mixed, "vec_id bigint, embedding array<double>")).collect()
        assert {r.query_id for r in got} == {0, 20, 100}
        assert recall(got, brute(mixed, 20, 20)) > 0.5
    small = [(i, [x * 1e-200 for x in v]) for i, v in rows]
    got = neighbours(spark.createDataFrame(small, "vec_id bigint, embedding array<double>")).collect()
    assert len(got) == 40
