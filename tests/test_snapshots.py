import datetime as dt

from pyspark.sql import functions as F

from fieldfit.operators import snapshots as s

BASE = "k string, v int, w string"


def base(frame):
    return frame(BASE, ("a", 1, "x"), ("b", 2, "y"))


def test_upsert_updates_payload_columns_only(frame, rows):
    new = frame("k string, v int", ("a", None), ("c", 3))
    assert rows(s.upsert(base(frame), new, ["k"])) == [("a", None, "x"), ("b", 2, "y"), ("c", 3, None)]


def test_upsert_is_idempotent(frame, rows):
    new = frame(BASE, ("a", 9, None), ("c", 3, "z"))
    once = s.upsert(base(frame), new, ["k"])
    assert rows(s.upsert(once, new, ["k"])) == rows(once)


def test_last_arrival_wins(frame, rows):
    new = frame(
        "k string, v int, arrival_file string, arrival_pos bigint",
        ("a", 1, "0:bundle", 9),
        ("a", 2, "1:chunk-00", 5),
        ("a", 3, "1:chunk-01", 0),
        ("a", 4, "1:chunk-00", 7),
    )
    assert rows(s.upsert(base(frame), new, ["k"]), "k", "v") == [("a", 3), ("b", 2)]


def test_upsert_composite_key_and_type(frame, rows):
    old = frame("t string, e string, v bigint", ("1", "x", 1), ("1", "y", 2))
    new = frame("t string, e string, v int", ("1", "x", 7), ("2", "x", 8))
    out = s.upsert(old, new, ["t", "e"])
    assert rows(out) == [("1", "x", 7), ("1", "y", 2), ("2", "x", 8)]
    assert out.schema == old.schema


def test_remove_stale_guard_counts_rows(frame, rows):
    old = frame(BASE, *[(str(i), i, "n") for i in range(60)])
    few = frame("k string", *[(str(i),) for i in range(49)])
    assert s.remove_stale(old, few, "k").count() == 60
    assert s.stale_keys(old, few, "k").count() == 0
    # 50 rows of one key pass the guard: rows count, not distinct keys.
    repeated = frame("k string", *[("1",)] * 50)
    assert rows(s.remove_stale(old, repeated, "k"), "k") == [("1",)]
    assert s.stale_keys(old, repeated, "k").count() == 59
    enough = frame("k string", *[(str(i),) for i in range(10, 65)])
    assert s.remove_stale(old, enough, "k").count() == 50


def test_removed_tickets_keep_their_notes(frame, rows):
    notes = frame("k string, note string", ("gone", "n1"), ("a", "n2"))
    kept = s.remove_stale(base(frame), frame("k string", ("a",)), "k", min_rows=1)
    assert rows(kept, "k") == [("a",)]
    assert rows(notes.join(kept, "k", "left").select("k", "note")) == [("a", "n2"), ("gone", "n1")]


def test_replace_by_key(frame, rows):
    old = frame("t string, p string, q int", ("1", "a", 1), ("1", "b", 2), ("2", "a", 3), (None, "n", 4))
    new = frame("p string, q int, t string", ("c", 9, "1"), ("c", 9, "1"), ("d", 5, "3"))
    assert rows(s.replace_by_key(old, new, "t")) == [
        ("1", "c", 9),
        ("1", "c", 9),
        ("2", "a", 3),
        ("3", "d", 5),
        (None, "n", 4),
    ]


def test_patch_never_inserts_and_skips(frame, rows):
    members = frame("email string, owner bigint", ("a@x", None), ("b@x", 2), ("c@x", 3))
    new = frame("email string, owner bigint", ("a@x", 0), ("b@x", None), ("", 5), (None, 6), ("zz@x", 7))
    assert rows(s.patch(members, new, "email", ["owner"])) == [("a@x", 0), ("b@x", 2), ("c@x", 3)]
    assert rows(s.patch_counts(members, new, "email", ["owner"])) == [(1, 5)]
    assert rows(s.patch(members, new, "email", ["owner"], skip="falsy"))[0] == ("a@x", None)


def test_patch_falsy_text(frame, rows):
    tickets = frame("t string, deal string", ("1", "old"), ("2", "old"), ("3", "old"))
    new = frame("t string, deal string", ("1", ""), ("2", "0"), ("3", None))
    assert rows(s.patch(tickets, new, "t", ["deal"], skip="falsy")) == [("1", "old"), ("2", "0"), ("3", "old")]


def test_patch_counts_every_payload_row_and_empty_payload(frame, rows):
    tickets = frame("t string, deal string", ("1", "old"))
    new = frame("t string, deal string", ("1", "a"), ("1", "b"), ("9", "c"))
    assert rows(s.patch_counts(tickets, new, "t", ["deal"])) == [(2, 3)]
    assert rows(s.patch_counts(tickets, new.limit(0), "t", ["deal"])) == [(0, 0)]
    assert rows(s.patch(tickets, new.limit(0), "t", ["deal"])) == [("1", "old")]


def test_stamp(frame):
    now = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
    df = frame("k int, synced_at timestamp", (1, None), (2, dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)))
    got = {r.k: r.y for r in s.stamp(df, now).select("k", F.year("synced_at").alias("y")).collect()}
    assert got == {1: 2024, 2: 2020}
    assert s.stamp(df.drop("synced_at"), now).filter("synced_at is null").count() == 0
