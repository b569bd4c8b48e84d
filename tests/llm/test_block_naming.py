"""Exact duplicates: SQL, brute force, hot groups, long texts, nulls and repeats."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from fieldfit.llm.block_naming import exact_duplicates

SCHEMA = "doc_id bigint, text string, _row string, block string, _name int"


def brute(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    out, left = [], {t: 1 for t in groups}
    for i, t in sorted(norm, key=lambda x: (x[0] is None, x[0] or 0)):
        known = [x for x in groups[t] if x is not None]
        keep = min(known) if known else None
        out.append((i, keep, len(groups[t]), bool(left.pop(t, 0)), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, **how):
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)
    got = [tuple(r) for r in exact_duplicates(df, **how).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_against_sql(against_sql):
    against_sql("op4_block_naming")


def test_random_texts_with_small_blocks_and_hot_groups(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab \t\n") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    rows = [(i, rng.choice(texts)) for i in range(400)] + [(1000 + i, texts[0]) for i in range(200)]
    check(spark, rows, block_chars=3, hot_rows=20)
    check(spark, rows, block_chars=3)


def test_nulls_repeats_and_emptiness(spark):
    check(spark, [(3, None), (2, ""), (None, ""), (2, ""), (7, "x  y"), (6, "x\t\ny"), (None, "z"), (8, " ")])
    check(spark, [])


def test_long_texts_that_differ_in_one_place(spark):
    base = "lorem ipsum " * 20000
    check(spark, [(1, base), (2, base), (3, base[:-2] + "x "), (4, "y" + base[1:]), (5, base + "\U0001f600" * 5000)])


def test_main_path_has_no_python(spark, plan):
    df = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    assert not re.search("Python|Arrow|Pandas|MapInPandas", plan(exact_duplicates(df)))
