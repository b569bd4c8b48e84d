"""SimHash: fingerprints bit by bit, linking against all pairs, large entries, odd rows."""

import random
import re

import xxhash

from fieldfit.llm.simhash import entry_masks, fingerprints, kept_rows, links, near_duplicates


def brute_fp(text, words=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not parts:
        return 0
    grams = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values):
    """{value: smallest id reachable} for (id, value) pairs."""
    left, out = {v for _, v in values}, {}
    while left:
        todo, group = [left.pop()], []
        while todo:
            v = todo.pop()
            group.append(v)
            near = {w for w in left if bin(v ^ w).count("1") <= 2}
            left -= near
            todo += near
        ids = [i for i, v in values if v in group and i is not None]
        out |= {v: min(ids, default=None) for v in group}
    return out


TEXTS = [None, "", " \t\n", "One", "one two", "one two three", "A b c d e f g", "a  B\tc d e f g", "É é É é É", " x y z w"]


def test_whole_result(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    texts = TEXTS + base + [b + " z" for b in base] + ["w " * 30000]
    rows = [(i, t, "c") for i, t in enumerate(texts)] + [(None, "One", "c"), (3, "One", "c"), (1000, TEXTS[6], "d")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string, fp string")).select("doc_id", "fingerprint", "component_id")
    fps = [(i, brute_fp(t)) for i, t, _ in rows]
    comp = brute_components(fps)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((i, f"{v:016x}", comp[v]) for i, v in fps), key=repr)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_links_of_clouds_with_small_and_large_entries(spark):
    rng = random.Random(8)
    values = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        values.add(centre)
        for _ in range(25):
            v = centre
            for b in rng.sample(range(64), rng.randint(1, 4)):
                v ^= 1 << b
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    from fieldfit.llm.common import components

    pairs = list(enumerate(sorted(values)))
    want = brute_components(pairs)
    for entry in (2, 64):
        roots = {r.node & (1 << 64) - 1: r.root for r in components(links(df, max_entry=entry)).collect()}
        groups = {}
        for v in values:
            groups.setdefault(roots.get(v, v), set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(
            sorted(v for v in values if want[v] == c) for c in set(want.values())
        )


def test_every_pair_within_reach_shares_an_entry():
    rng = random.Random(1)
    for bits in range(7):
        masks = [m & (1 << 64) - 1 for m in entry_masks(bits)]
        for _ in range(300):
            diff = sum(1 << b for b in rng.sample(range(64), bits))
            assert any(not diff & m for m in masks)


def test_fingerprints_keep_every_row(spark):
    df = spark.createDataFrame([(1, "a", 0)] * 3 + [(None, None, 1)], "doc_id bigint, text string, text_key int")
    assert fingerprints(df).count() == 4


def brute_kept(rows):
    """The (id, text) rows that stay: one per component, the smallest id first, NULL ids last."""
    comp, lowest = component_numbers([brute_fp(t) for _, t in rows]), {}
    for n, row in zip(comp, rows):
        rank = row[0] is None, row[0] or 0
        if n not in lowest or rank < lowest[n][0]:
            lowest[n] = rank, row
    return [row for _, row in lowest.values()]


def component_numbers(values):
    """A number for the component of each value."""
    left, number = set(values), {}
    while left:
        todo, n = [left.pop()], len(number)
        while todo:
            v = todo.pop()
            number[v] = n
            near = {w for w in left if bin(v ^ w).count("1") <= 2}
            left -= near
            todo += near
    return [number[v] for v in values]


def test_kept_rows_are_one_of_each_component(spark):
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(200, 400))) for _ in range(30)]
    texts = TEXTS + base + [b.upper() for b in base[:10]] + [b + " end" for b in base[:20]] + [b[:-3] for b in base[20:]]
    rows = [(None if i % 7 == 0 else 1000 - i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, i % 3) for i, r in enumerate(rows)], "doc_id bigint, text string, fp int").repartition(4)
    want = brute_kept(rows)
    assert 25 < len(want) < len(texts) - 15
    for entry in (64, 3):
        got = kept_rows(df, max_entry=entry)
        assert got.columns == df.columns
        # of rows of a component without keys the lowest hash stays, so compare these by number
        assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == sorted(i for i, _ in want if i is not None)
        assert got.count() == len(want)


def test_kept_rows_with_repeated_and_missing_ids(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    rows = [(1, one), (1, two), (2, one), (3, two), (None, "lone"), (None, "LONE"), (None, None), (None, ""), (1, one)]
    got = kept_rows(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.text or "").lower() for r in got) == sorted(["", "lone", one, two])
    assert all(r.doc_id == 1 for r in got if r.text in (one, two))
    assert kept_rows(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
