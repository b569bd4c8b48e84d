"""The pipeline stage by stage against brute-force versions, on the sample and on odd rows."""

import re

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from conftest import SF
from fieldfit.llm import language
from test_blob_ledger import BASE
from test_packing import check
from test_simhash import brute_components, brute_fp

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def masked(text):
    spans = sorted(
        (m.start(), m.end()) for _, pattern, group, least in BASE for m in pattern.finditer(text or "") if len(m.group(group)) >= least
    )
    out, upto = [], 0
    for a, b in spans:
        if a >= upto:
            out += [text[upto:a], "[secret]"]
        upto = max(upto, b)
    return "".join([*out, text[upto:]]) if spans else text


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    first = docs.orderBy("doc_id").first()
    odd = [
        (900001, None, None, None, None),
        (900002, "", "en", "src0", 0),
        (900003, "123 456 --", "en", "src0", 10),
        (None, "the of and to in a be is", "en", None, None),
        (900004, first.text.replace(" ", "  "), first.lang, "copy", 1),
        (900005, "the of and password = hunter2222 to in", "en", "src0", 38),
        (900005, "the of and password = hunter2222 to in", "en", "src0", 38),
    ]
    return docs.unionByName(spark.createDataFrame(odd, docs.schema))


def test_stages(spark, documents):
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_dedup", "secret_scan", "best_fit_packing"]

    def run(name, docs):
        out = stages[name](spark, docs, SF)
        assert out.columns == docs.columns
        return spark.createDataFrame(rows_of(out), docs.schema), rows_of(out)

    rows = rows_of(documents)
    names, scores = language.label([r[1] for r in rows], language.train(documents))
    kept, got = run("language_id", documents)
    assert got == [r for r, n, s in zip(rows, names, scores) if n != "und" and s >= corpus_pipeline.LEAST_SCORE]
    assert {r[0] for r in rows} - {r[0] for r in got} >= {900001, 900002, 900003}

    groups = {}
    for r in got:
        groups.setdefault(normal(r[1]), []).append(r)
    want = sorted((min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()), key=repr)
    kept, got = run("exact_dedup", kept)
    assert got == want

    fps = [(r[0], brute_fp(r[1])) for r in got]
    comp = brute_components(fps)
    want = [r for r, (_, fp) in zip(got, fps) if comp[fp] is None or r[0] == comp[fp]]
    kept, got = run("simhash_dedup", kept)
    assert got == want

    want = sorted(
        ((*r[:1], masked(r[1]), *r[2:4], r[4] if masked(r[1]) == r[1] else len(masked(r[1]))) for r in got), key=repr
    )
    kept, got = run("secret_scan", kept)
    assert got == want and any("[secret]" in r[1] for r in got)

    packed = stages["best_fit_packing"](spark, kept, SF).collect()
    check(packed, [(r[0], r[1]) for r in got], 4096)


def test_run_is_registered_and_packs_what_is_left(spark):
    assert entry_points.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.ORACLE_SQL is None
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0


def test_empty_documents_pass_every_stage(spark, documents):
    docs = documents.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_all_operators_are_registered():
    names = set(entry_points.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
