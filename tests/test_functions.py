import datetime as dt
import math
from dataclasses import replace
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from fieldfit import functions as fx
from fieldfit.config import DEFAULT_RULES as RULES
from fieldfit.config import DENIED_DEALS, GAP_TO_TARGET_BUCKETS
from fieldfit.functions.measures import ICP, SMB, grade_3_floor


def test_denied_deals_are_distinct():
    assert len(DENIED_DEALS) == len(set(DENIED_DEALS)) == 107


def grid(spark):
    pairs = [(t, i) for t in range(1, 61) for i in range(0, t + 3)] + [(200, 179), (200, 180), (300, 1)]
    return spark.createDataFrame(pairs, "t bigint, i bigint")


def test_ratio_grade_and_gaps_match_brute_force(spark):
    share = fx.pct(F.col("i"), F.col("t"))
    out = grid(spark).select(
        "t",
        "i",
        share.alias("pct"),
        fx.grade(share, F.lit(SMB), RULES).alias("smb"),
        fx.grade(share, F.lit(ICP), RULES).alias("icp"),
        fx.gap(RULES.target_share, F.col("t"), F.col("i")).alias("gap80"),
        fx.gap(grade_3_floor(F.lit(SMB), RULES), F.col("t"), F.col("i")).alias("gap90"),
    )
    for row in out.collect():
        pct = min(float((Decimal(row.i) / Decimal(row.t)).quantize(Decimal("0.01"), ROUND_HALF_UP)), 1.0)
        whole = round(pct * 100)
        assert row.pct == pct
        assert row.smb == (0 if whole == 0 else 1 + (whole > 75) + (whole > 89) + (whole > 95))
        assert row.icp == (0 if whole == 0 else 1 + (whole > 75) + (whole > 79) + (whole > 85))
        assert row.gap80 == max(-(-8 * row.t // 10) - row.i, 0)
        assert row.gap90 == max(-(-9 * row.t // 10) - row.i, 0)


def test_grade_uses_the_rounded_ratio_and_gap_the_exact_one(frame):
    df = frame("t bigint, i bigint", (200, 179))
    share = fx.pct(F.col("i"), F.col("t"))
    row = df.select(
        fx.grade(share, F.lit(SMB), RULES).alias("g"),
        fx.gap(RULES.smb_scale.grade_3_floor, F.col("t"), F.col("i")).alias("gap"),
    ).first()
    assert (row.g, row.gap) == (3, 1)


def test_ratio_edges(frame):
    df = frame("t bigint, i bigint", (0, 5), (300, 1), (2, 9))
    assert [r[0] for r in df.select(fx.pct(F.col("i"), F.col("t"))).collect()] == [1.0, 0.0, 1.0]


def test_published_example(frame):
    row = (
        frame("t bigint, i bigint", (73, 4))
        .select(
            fx.pct(F.col("i"), F.col("t"), 4).alias("pct"),
            fx.gap(RULES.target_share, F.col("t"), F.col("i")).alias("gap"),
        )
        .first()
    )
    assert (row.pct, row.gap) == (0.0548, 55)


def test_segment_and_scale(frame):
    df = frame(
        "d int, p double", (90, 60.0), (91, 60.0), (91, 50.0), (None, 60.0), (None, None), (10, None), (10, 51.0)
    )
    seg = fx.segment(F.col("d"), F.col("p"), RULES)
    got = [tuple(r) for r in df.select(seg, fx.scale(seg, F.col("p"), RULES)).collect()]
    assert got == [
        ("Onboarding", "ICP"),
        ("ICP", "ICP"),
        ("SMB", "SMB"),
        ("ICP", "ICP"),
        ("SMB", "SMB"),
        ("Onboarding", "SMB"),
        ("Onboarding", "ICP"),
    ]


def test_eligibility_by_class(frame):
    df = frame(
        "s string, c string",
        ("Onboarding", "Primeira venda, Upsell"),
        ("Onboarding", "Upsell"),
        ("ICP", "Primeira venda"),
        ("SMB", "Troca"),
        (None, "Troca"),
    )
    assert [r[0] for r in df.select(fx.eligible(F.col("s"), F.col("c"))).collect()] == [True, False, False, True, False]


def test_in_time_agrees_with_days_left(frame):
    df = frame("s string, d int", *[(s, d) for s in ("Onboarding", "ICP", "SMB") for d in (-5, 0, 60, 61, 90, 91)])
    out = df.select(
        fx.in_time(F.col("s"), F.col("d"), RULES).alias("ok"), fx.days_left(F.col("s"), F.col("d"), RULES).alias("left")
    )
    assert all(r.ok == (r.left >= 0) for r in out.collect())
    changed = replace(RULES, other_days=10)
    assert df.select(fx.days_left(F.lit("ICP"), F.lit(4), changed)).first()[0] == 6


def test_install_status(frame):
    start = dt.date(2024, 5, 1)
    df = frame(
        "service date, has_order boolean, start date",
        (dt.date(2024, 5, 1), True, start),
        (dt.date(2024, 4, 30), True, start),
        (None, True, start),
        (None, False, start),
        (dt.date(2024, 5, 1), True, None),
    )
    out = df.select(fx.install_status(F.col("service"), F.col("has_order"), F.col("start")))
    assert [r[0] == "Instalado" for r in out.collect()] == [True, False, True, False, False]


def test_text_scalars(frame):
    df = frame("o string", ("123-4",), ("123",), ("12-3-10",), ("x-",), (None,))
    ident, number = fx.split_suffix(F.col("o"))
    assert [tuple(r) for r in df.select(ident, number).collect()] == [
        ("123", 4),
        ("123", None),
        ("12-3", 10),
        ("x-", None),
        (None, None),
    ]
    serials = frame("s string", (" 1, 2/3 | 4 ",), ("",), (None,), (",/|",))
    items, count = fx.split_list(F.col("s"))
    assert [tuple(r) for r in serials.select(items, count).collect()] == [
        (["1", "2", "3", "4"], 4),
        ([], 0),
        ([], 0),
        ([], 0),
    ]


def test_display_name(frame):
    df = frame(
        "s string, c string",
        ("[SUPPLY | motivo] Instalação ACME LTDA Deal ID: 12", None),
        ("[SUPPLY | motivo] Instalação ACME LTDA Deal ID: 12", "Acme"),
        ("Outro assunto", None),
    )
    got = [r[0] for r in df.select(fx.display_name(F.col("s"), F.col("c"))).collect()]
    assert got == ["ACME LTDA", "Acme", "Outro assunto"]


def test_risk_bucket_and_dates(frame):
    df = frame("v int", (2,), (3,), (None,), (16,), (0,))
    assert [r[0] for r in df.select(fx.risk_status(F.col("v"))).collect()] == ["em_risco", "ok", "ok", "ok", "em_risco"]
    labels = [r[0] for r in df.select(fx.bucket(F.col("v"), GAP_TO_TARGET_BUCKETS)).collect()]
    assert labels == ["1-4", "1-4", None, "16+", None]
    now = dt.datetime(2024, 1, 3, 12, tzinfo=dt.timezone.utc)
    times = frame("t timestamp", (dt.datetime(2024, 1, 1, 0, tzinfo=dt.timezone.utc),), (None,))
    row = times.select(
        fx.days_open(F.col("t"), now).alias("open"), fx.is_stale(F.col("t"), now).alias("stale")
    ).collect()
    assert math.isclose(row[0].open, 2.5) and row[0].stale and row[1].open is None
    text = frame("d string", ("2024-02-30",), ("2024-02-29",))
    assert [r[0] for r in text.select(fx.as_date(F.col("d"))).collect()] == [None, dt.date(2024, 2, 29)]


def test_label_set_is_sorted(frame):
    df = frame("k int, v string", (1, "b"), (1, "a"), (1, "b"), (1, None))
    assert df.groupBy("k").agg(fx.sorted_label_set(F.col("v")).alias("l")).first().l == "a, b"
