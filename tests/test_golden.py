"""FIXTURES.md golden vectors: RSI, divergence cases, signal lifecycle."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlewick.operators import divergence as dv
from candlewick.operators import lifecycle as lc
from candlewick.operators.rsi import rsi, rsi_warmup
from candlewick.operators.sequence import BLK, T

CLOSES = [100, 102, 101, 105, 104, 103, 107, 106, 108, 110, 109, 111, 110, 112, 115, 114]
UP_EWMA = [0.0, 0.142857, 0.132653, 0.408892, 0.379686, 0.352565, 0.613096, 0.569304, 0.671496,
           0.766389, 0.711647, 0.803672, 0.746267, 0.835820, 0.990404, 0.919661]
DOWN_EWMA = [0.0, 0.0, 0.071429, 0.066327, 0.133017, 0.194945, 0.181020, 0.239519, 0.222410,
             0.206524, 0.263201, 0.244401, 0.298372, 0.277060, 0.257270, 0.310322]
RSI = [None, None, 65.0, 86.042945, 74.055646, 64.394289, 77.204830, 70.386731, 75.119292,
       78.772636, 73.000847, 76.680955, 71.437795, 75.104243, 79.380045, 74.770221]


def _candles(spark, closes, symbol="X", start=dt.datetime(2024, 1, 1), step=dt.timedelta(hours=1)):
    rows = [(symbol, start + i * step, float(c), float(c), float(c), float(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, datetime timestamp_ntz, open double, "
                                       "high double, low double, close double")


@pytest.mark.parametrize("block_rows", [2048, 4, 5])
def test_rsi_golden(spark, block_rows):
    got = rsi(_candles(spark, CLOSES), "1 hour", block_rows=block_rows).orderBy("datetime").collect()
    assert len(got) == 16
    for i, r in enumerate(got):
        assert round(r.up_ewma, 6) == pytest.approx(UP_EWMA[i], abs=1e-6)
        assert round(r.down_ewma, 6) == pytest.approx(DOWN_EWMA[i], abs=1e-6)
        if RSI[i] is None:
            assert r.rsi is None
        else:
            assert r.rsi == pytest.approx(RSI[i], abs=1e-6)


def test_rsi_warmup_golden(spark):
    got = rsi_warmup(_candles(spark, CLOSES), "1 hour").orderBy("datetime").collect()
    for i, r in enumerate(got):
        if i < 14:
            assert r.RSI is None and r.AU is None
        else:
            assert r.RSI == pytest.approx(RSI[i], abs=1e-6)


def _rsi_frame(spark, rows):
    """rows oldest first: (rsi, low, high) -> frame shaped like rsi_frame output."""
    base = dt.datetime(2024, 1, 1)
    data = [("X", base + dt.timedelta(hours=i), i, 0, None if r is None else float(r), float(lo), float(hi),
             float(lo)) for i, (r, lo, hi) in enumerate(rows)]
    return spark.createDataFrame(data, f"symbol string, datetime timestamp_ntz, {T} long, {BLK} long, "
                                       "rsi double, low double, high double, close double")


CASES = [
    ("bullish", [(25, 50, 60), (35, 45, 55)], True, False),
    ("newest rsi below", [(25, 50, 60), (20, 45, 55)], False, False),
    ("equal low", [(25, 45, 60), (35, 45, 55)], False, False),
    ("boundary 30", [(30, 50, 60), (30, 45, 55)], True, False),
    ("bearish", [(75, 50, 60), (65, 55, 70)], False, True),
    ("boundary 70", [(70, 50, 60), (70, 55, 70)], False, True),
    ("null newest", [(25, 50, 60), (None, 45, 55)], False, False),
    ("both kinds", [(25, 50, 60), (75, 40, 54), (40, 45, 55)], True, True),
    ("row 31 back", [(25, 50, 60)] + [(50, 40, 60)] * 29 + [(35, 45, 55)], False, False),
]


@pytest.mark.parametrize("name,rows,bull,bear", CASES, ids=[c[0] for c in CASES])
def test_divergence_cases(spark, name, rows, bull, bear):
    f = dv.divergence_flags(_rsi_frame(spark, rows), block_rows=2048)
    last = f.orderBy(F.col(T).desc()).first()
    assert (last.bull, last.bear) == (bull, bear)


def test_both_kinds_emit_bearish(spark):
    f = dv.divergence_flags(_rsi_frame(spark, CASES[7][1]), block_rows=2048)
    s = dv.signals(f.where(F.col(T) == 2)).collect()
    assert [r.diversions for r in s] == [2]


LIFE = [  # datetime, close, bull, bear -> kind, pct, converted, age, live_after
    (dt.datetime(2024, 1, 1, 9), 100.0, 0, 0, 0, None, None, None, False),
    (dt.datetime(2024, 1, 2, 9), 100.0, 1, 0, 1, 0.0, False, 0, True),
    (dt.datetime(2024, 1, 3, 9), 95.0, 1, 0, 1, 5.263158, True, 1, True),
    (dt.datetime(2024, 1, 4, 9), 105.0, 0, 1, 1, -4.761905, False, 2, False),
    (dt.datetime(2024, 1, 5, 9), 110.0, 1, 1, 2, 0.0, False, 0, True),
    (dt.datetime(2024, 1, 6, 9), 115.5, 0, 0, 2, -4.761905, True, 1, True),
]


@pytest.mark.parametrize("block_rows", [2048, 2, 3])
def test_lifecycle_golden(spark, block_rows):
    # daily ticks: blocks must span two days, so 2 and 3 become 4-row blocks (two blocks here)
    data = [("X", d, i, i // block_rows, c, bool(b), bool(br)) for i, (d, c, b, br, *_) in enumerate(LIFE)]
    flags = spark.createDataFrame(data, f"symbol string, datetime timestamp_ntz, {T} long, {BLK} long, "
                                        "close double, bull boolean, bear boolean")
    got = lc.lifecycle(flags, "1 day", block_rows=block_rows).orderBy(T).collect()
    for r, (_, _, _, _, kind, pct, conv, age, live) in zip(got, LIFE):
        assert r.kind == kind
        assert (r.pct is None) == (pct is None)
        if pct is not None:
            assert round(r.pct, 6) == pytest.approx(pct, abs=1e-6)
        assert r.converted == conv
        assert r.age_days == age
        assert r.live_after == live


def test_conversion_direction(spark):
    rows = [("X", dt.datetime(2024, 1, 3, 9), 95.0)]
    now = spark.createDataFrame(rows, "symbol string, datetime timestamp_ntz, close double")
    sig = spark.createDataFrame([("X", dt.datetime(2024, 1, 2, 9), 100.0, 1)],
                                "symbol string, datetime timestamp_ntz, close double, diversions int")
    literal = lc.conversion_check(now, sig).first()
    intended = lc.conversion_check(now, sig, direction="intended").first()
    assert round(literal.pct, 6) == 5.263158 and literal.convert == 1 and literal.age_days == 1
    assert intended.convert == 0 and not literal.expired


def test_elapsed_days_floor(spark):
    from candlewick.functions.timefn import elapsed_days
    rows = [(dt.datetime(2024, 1, 3, 8, 59), 1), (dt.datetime(2024, 1, 3, 9, 0), 2),
            (dt.datetime(2024, 1, 2, 9, 0), 1), (dt.datetime(2024, 1, 1, 10, 0), 0)]
    df = spark.createDataFrame([(d, dt.datetime(2024, 1, 1, 9, 0), e) for d, e in rows],
                               "now timestamp_ntz, sig timestamp_ntz, expect int")
    got = df.select(elapsed_days("now", "sig").alias("d"), "expect").collect()
    assert all(r.d == r.expect for r in got)


def test_duplicate_datetimes_dedupe_then_rsi(spark):
    from candlewick.operators.topn import dedupe_latest
    base = _candles(spark, CLOSES).withColumn("ingested_at", F.col("datetime"))
    stale = base.withColumn("close", F.col("close") * 2).withColumn(
        "ingested_at", F.col("datetime") - F.expr("INTERVAL 1 MINUTE"))
    clean = dedupe_latest(base.unionByName(stale), ["symbol", "datetime"], "ingested_at").drop("ingested_at")
    got = rsi(clean, "1 hour", block_rows=4).orderBy("datetime").collect()
    assert [None if r.rsi is None else round(r.rsi, 6) for r in got] == RSI
