"""Chat formatting: folding against a loop over the sorted log, round trips, whole query against SQL."""

import hashlib
import random

import duckdb
from conftest import SF

from fieldfit.llm import chat_format as chat
from fieldfit.llm.queries import QUERIES, SQL

SCHEMA = "conv_id bigint, message bigint, seq bigint, kind string, role string, text string, message_ string, conv string"
ODD = ["", "\\", "\\\\#", "#\\#", "##", "#####", "</turn>", "<\\/turn>", "</turn</turn>", "### user:\n", "a\nb\r\n", "\\n", "é😀 \u2028", "\\### Assistant: </turn> ok"]


def brute_fold(events):
    out = {}
    rank = {"delta": 1}
    none_first = lambda v: (v is not None, v or 0)
    for conv, message, seq, kind, role, text in sorted(set(events), key=lambda e: (none_first(e[2]), rank.get(e[3], 0), e[5] or "")):
        held = out.setdefault((conv, message), ["", ""])
        if kind == "message":
            held[0] = role or ""
        if kind == "delta":
            held[1] += text or ""
        else:
            held[1] = "" if kind == "regenerate" else text or ""
    return sorted(((*k, *v) for k, v in out.items()), key=repr)


def log(rng, n):
    events = []
    for conv in [*range(12), None]:
        for message in [*range(rng.randint(1, 4)), None]:
            seqs = rng.sample(range(10_000), n)
            for i, seq in enumerate(seqs):
                kind = rng.choices(["message", "delta", "edit", "regenerate"], [1 if i else 5, 8, 1, 1])[0]
                events.append((conv, message, seq, kind, rng.choice(["user", "assistant", None]), rng.choice([*ODD, None, "word "])))
    return events


def test_folding_is_that_of_the_sorted_log(spark):
    events = log(random.Random(4), 12)
    events += events[::9]  # delivered twice
    df = spark.createDataFrame([(*e, "x", "y") for e in events], SCHEMA).repartition(3)
    got = [tuple(r) for r in chat.folded(df).select("conv_id", "message", "role", "text").collect()]
    assert sorted(got, key=repr) == brute_fold(events)


def test_events_at_one_place(spark):
    rows = [(1, 1, 5, "delta", None, "b"), (1, 1, 5, "delta", None, "a"), (1, 1, 5, "message", "user", "c"), (1, 2, None, "delta", None, "z"), (1, 2, 1, "delta", None, None)]
    got = chat.folded(spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)).select("message", "role", "text").collect()
    assert sorted(map(tuple, got)) == [(1, "user", "cab"), (2, "", "z")]


def test_an_unknown_kind_stops_the_run(spark):
    import pytest

    for kind in ("remove", None):
        with pytest.raises(Exception, match="unknown kind"):
            chat.folded(spark.createDataFrame([(1, 1, 1, kind, None, "", "", "")], SCHEMA)).collect()


def test_rendering_reads_back_and_masks(spark):
    rng = random.Random(9)
    rows = [(c, m, rng.choice(["user", "assistant", "a:\nb\\n", "###", "", None]), rng.choice([*ODD, "".join(rng.choices("#\\</turn>\n ae", k=40)), None])) for c in [*range(30), None] for m in range(rng.randint(1, 9))]
    chats = chat.rendered(spark.createDataFrame(rows, "conv_id bigint, message bigint, role string, text string"))
    back = sorted((tuple(r)[:5] for r in chat.read_back(chats).collect()), key=repr)
    assert back == sorted(((c, m, r or "", t or "", (t or "") if r == "assistant" else None) for c, m, r, t in rows), key=repr)
    for r in chats.collect():
        said = [(x[2], x[3] or "") for x in sorted(x for x in rows if x[0] == r.conv_id)] if r.conv_id is not None else None
        assert "##" not in r.formatted.replace("### ", "")
        assert r.formatted.count("</turn>") == len(r.turns)
        if said:
            undone = [r.formatted[t.start : t.stop].replace("\\\\", "\0").replace("\\#", "#").replace("\\/", "/").replace("\0", "\\") for t in r.turns]
            assert undone == [t for _, t in said] and [t.loss for t in r.turns] == [x == "assistant" for x, _ in said]


def test_digests_of_odd_rows(spark):
    rows = [(1, 0, "user", t, i) for i, t in enumerate(["b", "b", None])] + [(None, None, None, None, 9), (2, 1, "assistant", "x" * 200_000 + "😀", 10)]
    got = {r.conv_id: r for r in chat.digests(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, row int")).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].n_turns == 3 and got[1].loss_chars == 0 and got[1].loss_sha256 == sha("")
    assert got[None].n_turns == 1 and got[None].turns_sha256 == sha("\n\n")
    assert got[2].loss_chars == 200_001 and got[2].loss_sha256 == sha("x" * 200_000 + "😀")
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string, row int")
    assert chat.digests(empty).count() == 0


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    result = con.execute(SQL["op11_event_sourced_chat"])
    names = [d[0] for d in result.description]
    theirs = sorted(result.fetchall())
    assert sorted(map(tuple, QUERIES["op11_event_sourced_chat"](spark, SF).select(*names).collect())) == theirs
    probe = "".join(f"{r}\n\\### Assistant: </turn> ok\n" for r in ("user", "assistant"))
    assert theirs[0][:3] == (-7, 2, hashlib.sha256(probe.encode()).hexdigest())
