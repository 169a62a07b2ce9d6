"""Operators on the driver tables vs. plain sequential loops (tests/brute.py)."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.operators import divergence as dv
from candlewick.operators import lifecycle as lc
from candlewick.operators import topn
from candlewick.operators.ewma import ewma
from candlewick.operators.resample import candles_from_ticks, resample_candles
from candlewick.operators.rsi import frame_rows, rsi_frame, rsi_tail, rsi_warmup
from candlewick.operators.sequence import T, with_row_index
from candlewick.sources.klines import decode_kline_payload, pack_kline_payload
from candlewick.sources.ticks import event_ticks
from tests import brute
from tests.conftest import SF001


@pytest.fixture(scope="module")
def candles_1h(spark):
    return candles_from_ticks(event_ticks(spark, SF001), "1 hour").cache()


def test_candles_match_pandas(spark):
    ticks = event_ticks(spark, SF001)
    got = candles_from_ticks(ticks, "4 hours").toPandas().sort_values(["symbol", "datetime"])
    exp = brute.candles_pd(ticks.toPandas(), "4h").sort_values(["symbol", "datetime"])
    assert len(got) == len(exp)
    for c in ["open", "high", "low", "close", "NumTrades"]:
        assert list(got[c]) == list(exp[c]), c


def test_tie_break_on_seq(spark):
    rows = [("X", "2024-01-01 00:10:00", 2, 5.0), ("X", "2024-01-01 00:10:00", 1, 7.0),
            ("X", "2024-01-01 00:20:00", 3, 6.0), ("X", "2024-01-01 00:20:00", 4, 9.0)]
    t = (spark.createDataFrame(rows, "symbol string, ts string, seq long, price double")
         .withColumn("ts", F.to_timestamp_ntz("ts")).withColumn("qty", F.lit(1.0)))
    r = candles_from_ticks(t, "1 hour").first()
    assert (r.open, r.close, r.high, r.low) == (7.0, 9.0, 9.0, 5.0)


def test_resample_equals_direct(spark, candles_1h):
    a = resample_candles(candles_1h, "4 hours")
    b = candles_from_ticks(event_ticks(spark, SF001), "4 hours")
    cols = ["symbol", "datetime", "open", "high", "low", "close", "NumTrades"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
    assert a.count() == b.count()


def test_row_index_dense(spark, candles_1h):
    idx = with_row_index(candles_1h, 3_600_000_000 * 7)  # 7-hour spans: many spans per symbol
    pdf = idx.select("symbol", "datetime", T).toPandas().sort_values(["symbol", "datetime"])
    for _, g in pdf.groupby("symbol"):
        assert list(g[T]) == list(range(len(g)))


@pytest.mark.parametrize("block_rows", [16, 61, 4096])
def test_rsi_blocks_match_brute(spark, candles_1h, block_rows):
    got = (rsi_frame(candles_1h, "1 hour", block_rows=block_rows)
           .select("symbol", "datetime", "up_ewma", "down_ewma", "rsi").toPandas())
    src = candles_1h.select("symbol", "datetime", "close").toPandas().sort_values(["symbol", "datetime"])
    exp = []
    for sym, g in src.groupby("symbol"):
        for d, (_, _, ue, de, r) in zip(g["datetime"], brute.rsi_rows(list(g["close"]))):
            exp.append((sym, d, ue, de, r))
    exp = pd.DataFrame(exp, columns=["symbol", "datetime", "ue", "de", "r"])
    m = got.merge(exp, on=["symbol", "datetime"])
    assert len(m) == len(exp) == len(got)
    assert (m.up_ewma - m.ue).abs().max() < 1e-9
    assert (m.down_ewma - m.de).abs().max() < 1e-9
    both = m.dropna(subset=["rsi", "r"])
    assert len(both) == m["r"].notna().sum() == m["rsi"].notna().sum()
    assert (both.rsi - both.r).abs().max() < 1e-9


def test_exact_fold_is_bit_identical(spark, candles_1h):
    """With blocks longer than the warm-up, exact mode reproduces the fold bits."""
    got = rsi_frame(candles_1h, "1 hour", block_rows=700, exact=True).select("symbol", "datetime", "up_ewma").toPandas()
    src = candles_1h.select("symbol", "datetime", "close").toPandas().sort_values(["symbol", "datetime"])
    mism = 0
    for sym, g in src.groupby("symbol"):
        exp = [x[2] for x in brute.rsi_rows(list(g["close"]))]
        mine = got[got.symbol == sym].sort_values("datetime")["up_ewma"].tolist()
        mism += sum(a != b for a, b in zip(mine, exp))
    assert mism == 0


def test_rsi_tail_matches_brute(spark, candles_1h):
    got = rsi_tail(candles_1h, "1 hour", tail=20, block_rows=32).toPandas()
    src = candles_1h.select("symbol", "datetime", "close").toPandas().sort_values(["symbol", "datetime"])
    worst = 0.0
    for sym, g in src.groupby("symbol"):
        closes = list(g["close"])
        mine = got[got.symbol == sym].sort_values("datetime")["up_ewma"].tolist()
        for i in range(len(closes)):
            tail = closes[max(0, i - 19): i + 1]
            ups = [x[0] for x in brute.rsi_rows(tail)]
            worst = max(worst, abs(brute.fold(ups) - mine[i]))
    assert worst < 1e-12


def test_public_ewma_seeded(spark, candles_1h):
    got = ewma(candles_1h, "close", 13, "e", 3_600_000_000, block_rows=16).toPandas()
    src = candles_1h.select("symbol", "datetime", "close").toPandas().sort_values(["symbol", "datetime"])
    for sym, g in src.groupby("symbol"):
        closes = list(g["close"])
        mine = got[got.symbol == sym].sort_values("datetime")["e"].tolist()
        for i in (0, 1, 17, len(closes) - 1):
            assert mine[i] == pytest.approx(brute.fold(closes[: i + 1]), rel=1e-12)


@pytest.mark.parametrize("block_rows", [40, 2048])
def test_flags_and_lifecycle_match_brute(spark, block_rows):
    c = candles_from_ticks(event_ticks(spark, SF001), "4 hours")
    rows = rsi_frame(c, "4 hours", block_rows=block_rows)
    f = dv.divergence_flags(rows, frame_rows(13, block_rows, False)).cache()
    life = lc.lifecycle(f, block_rows=block_rows).toPandas()
    pdf = f.select("symbol", "datetime", "close", "low", "high", "rsi", "bull", "bear").toPandas()
    for sym, g in pdf.sort_values(["symbol", "datetime"]).groupby("symbol"):
        rs = [None if (r is None or (isinstance(r, float) and math.isnan(r))) else r for r in g["rsi"]]
        exp = brute.flags(list(zip(rs, g["low"], g["high"])))
        assert list(zip(g["bull"], g["bear"])) == exp
        ticks = list(zip(g["datetime"], g["close"], g["bull"], g["bear"]))
        exp_life = brute.lifecycle([(d.to_pydatetime(), c_, b, br) for d, c_, b, br in ticks])
        mine = life[life.symbol == sym].sort_values("datetime")
        assert list(mine["kind"]) == [e["kind"] for e in exp_life]
        assert list(mine["live_after"]) == [e["live_after"] for e in exp_life]


def test_newest_and_drop(spark, candles_1h):
    top = topn.newest_n(candles_1h, 3).toPandas()
    assert top.groupby("symbol").size().max() == 3
    rest = topn.drop_newest(candles_1h, 3)
    assert rest.count() + top.shape[0] == candles_1h.count()
    closed = topn.closed_latest(candles_1h).toPandas()
    two = top[top.rn == 2].sort_values("symbol")
    assert list(closed.sort_values("symbol")["datetime"]) == list(two["datetime"])


def test_dedupe_keeps_latest_and_is_idempotent(spark, candles_1h):
    v1 = candles_1h.withColumn("ingested_at", F.col("datetime")).withColumn("close", F.lit(-1.0))
    v2 = candles_1h.withColumn("ingested_at", F.col("datetime") + F.expr("INTERVAL 1 HOUR"))
    d = topn.dedupe_latest(v1.unionByName(v2), ["symbol", "datetime"], "ingested_at")
    assert d.where("close = -1.0").count() == 0
    assert d.count() == candles_1h.count()
    again = topn.dedupe_latest(d.unionByName(d), ["symbol", "datetime"], "ingested_at")
    assert again.exceptAll(d).count() == 0 and d.exceptAll(again).count() == 0


def test_json_payload_decode_exchange_format(spark):
    raw = ('[[1704067200000,"42000.5","42100.0","41900.25","42050.75","12.5",1704153599999,'
           '"525000.1",1234,"6.1","256000.2","0"]]')
    df = spark.createDataFrame([("XYZUSD", raw)], "symbol string, payload string")
    r = decode_kline_payload(df).first()
    assert str(r.datetime) == "2024-01-01 09:00:00"  # 00:00 UTC as Seoul wall clock
    assert (r.open, r.close, r.NumTrades, r.Ignore) == (42000.5, 42050.75, 1234, "0")
    assert r.TakerBuyQuoteAssetVolume == 256000.2


def test_json_roundtrip(spark, candles_1h):
    back = decode_kline_payload(pack_kline_payload(candles_1h, "1 hour"), tz=None)
    cols = ["symbol", "datetime", "open", "high", "low", "close", "volume", "NumTrades"]
    assert back.select(cols).exceptAll(candles_1h.select(cols)).count() == 0
    assert back.count() == candles_1h.count()


def test_running_list_form_equals_blocked(spark, candles_1h):
    from candlewick.operators.ewma import ewma_running_list
    a = ewma_running_list(candles_1h, "close", 13, "e").select("symbol", "datetime", "e").toPandas()
    b = ewma(candles_1h, "close", 13, "e", 3_600_000_000, block_rows=16).select(
        "symbol", "datetime", "e").toPandas()
    m = a.merge(b, on=["symbol", "datetime"])
    assert len(m) == len(a) and (m.e_x - m.e_y).abs().max() < 1e-9


@pytest.mark.parametrize("density", [2, 3, 7])
def test_lifecycle_dense_flags_many_blocks(spark, density):
    """Flags on most ticks keep signals chained across every block edge: the
    block transfer maps must compose exactly like the sequential replay."""
    c = candles_from_ticks(event_ticks(spark, SF001), "1 hour")
    seq = with_row_index(c, 3_600_000_000 * 64)
    f = (seq.withColumn("bull", (F.pmod(F.xxhash64("datetime", "symbol"), F.lit(density)) != 0))
            .withColumn("bear", (F.pmod(F.xxhash64("symbol", "datetime"), F.lit(5)) == 0)))
    life = lc.lifecycle(f, block_rows=50).toPandas()
    pdf = f.select("symbol", "datetime", "close", "bull", "bear").toPandas()
    assert len(life) == len(pdf)
    for sym, g in pdf.sort_values(["symbol", "datetime"]).groupby("symbol"):
        exp = brute.lifecycle([(d.to_pydatetime(), c_, b, br) for d, c_, b, br in
                               zip(g["datetime"], g["close"], g["bull"], g["bear"])])
        mine = life[life.symbol == sym].sort_values("datetime")
        assert list(mine["kind"]) == [e["kind"] for e in exp]
        assert list(mine["live_after"]) == [e["live_after"] for e in exp]
        assert [None if a != a else a for a in mine["age_days"]] == [e["age_days"] for e in exp]


def test_two_level_prefix_sum(spark):
    from candlewick.operators.sequence import prefix_sum
    rows = [(k, o, (o * 7 + len(k)) % 5) for k in ("a", "bb") for o in range(0, 40, 3)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = prefix_sum(df, "k", "o", "v", "p", group=4, one_window=1).toPandas().sort_values(["k", "o"])
    for k, g in got.groupby("k"):
        vals = list(g["v"])
        assert list(g["p"]) == [sum(vals[:i]) for i in range(len(vals))]


def test_hot_symbol_spreads_over_tasks(spark):
    """One symbol holding every row: its blocks land in many partitions and
    the RSI still equals the sequential fold."""
    from candlewick.sources.tables import table
    from candlewick.sources.ticks import ticks_from
    from candlewick.operators.sequence import BLK, blocks_with_halo
    from tests.conftest import SF01
    orders = table(spark, SF01, "orders").withColumn("one", F.lit("ALL"))
    ticks = ticks_from(orders, "one", "o_orderdate", "o_orderkey", "o_totalprice")
    c = candles_from_ticks(ticks, "1 day")
    seq = with_row_index(c, 86_400_000_000 * 128)
    parts = (blocks_with_halo(seq, 128, 1).repartition(8, "symbol", BLK)
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts >= 4
    got = rsi_frame(c, "1 day", block_rows=128).select("datetime", "up_ewma", "rsi").toPandas()
    src = c.select("datetime", "close").toPandas().sort_values("datetime")
    exp = brute.rsi_rows(list(src["close"]))
    mine = got.sort_values("datetime")
    assert len(mine) == len(exp) > 2000
    assert max(abs(a - b[2]) for a, b in zip(mine["up_ewma"], exp)) < 1e-6 * max(b[2] for b in exp)


def test_exact_fold_bits_across_blocks(spark):
    """~2,400 daily candles of one symbol in 700-row blocks (longer than the
    600-row warm-up): every EWMA value has the bits of one sequential fold."""
    from candlewick.sources.tables import table
    from candlewick.sources.ticks import ticks_from
    from tests.conftest import SF01
    orders = table(spark, SF01, "orders").withColumn("one", F.lit("ALL"))
    c = candles_from_ticks(ticks_from(orders, "one", "o_orderdate", "o_orderkey", "o_totalprice"), "1 day")
    got = rsi_frame(c, "1 day", block_rows=700, exact=True).select("datetime", "_blk", "up_ewma", "down_ewma").toPandas()
    got = got.sort_values("datetime")
    assert got["_blk"].nunique() >= 3
    exp = brute.rsi_rows(list(c.select("datetime", "close").toPandas().sort_values("datetime")["close"]))
    assert list(got["up_ewma"]) == [e[2] for e in exp]
    assert list(got["down_ewma"]) == [e[3] for e in exp]


@pytest.mark.parametrize("one_window", [1, 8, 40, 1000])
def test_multi_level_prefix_sum(spark, one_window):
    from candlewick.operators.sequence import prefix_sum
    rows = [(k, o, (o * 7 + len(k)) % 5) for k in ("a", "bb") for o in range(0, 90, 2)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = prefix_sum(df, "k", "o", "v", "p", group=3, one_window=max(2, one_window)).toPandas().sort_values(["k", "o"])
    for k, g in got.groupby("k"):
        vals = list(g["v"])
        assert list(g["p"]) == [sum(vals[:i]) for i in range(len(vals))]


@pytest.mark.parametrize("com,block_rows", [(200.0, 64), (2000.0, 32), (13.0, 7)])
def test_long_memory_ewma_matches_a_plain_loop(spark, candles_1h, com, block_rows):
    """A long memory reaches over very many blocks: the carry goes by levels."""
    got = ewma(candles_1h, "close", com, "e", 3_600_000_000, block_rows=block_rows).toPandas()
    src = candles_1h.select("symbol", "datetime", "close").toPandas().sort_values(["symbol", "datetime"])
    for sym, g in src.groupby("symbol"):
        e, exp = None, []
        for x in g["close"]:
            e = x if e is None else (1 - 1 / (com + 1)) * e + x / (com + 1)
            exp.append(e)
        mine = got[got.symbol == sym].sort_values("datetime")["e"].tolist()
        assert mine == pytest.approx(exp, rel=1e-10)


def test_exact_fold_at_any_com(spark, candles_1h):
    """com = 200 needs a warm-up of over 8,000 rows: blocks are made that long."""
    got = rsi_frame(candles_1h, "1 hour", com=200, block_rows=64, exact=True).select("symbol", "datetime", "up_ewma").toPandas()
    src = candles_1h.select("symbol", "datetime", "close").toPandas().sort_values(["symbol", "datetime"])
    for sym, g in src.groupby("symbol"):
        prev, e, exp = None, None, []
        for x in g["close"]:
            up = max(x - prev, 0.0) if prev is not None else 0.0
            e = up if e is None else (1 - 1 / 201) * e + (1 / 201) * up
            prev = x
            exp.append(e)
        assert got[got.symbol == sym].sort_values("datetime")["up_ewma"].tolist() == exp


@pytest.mark.parametrize("minutes", [1, 60, 60 * 24 * 5])
def test_lifecycle_at_any_tick_density(spark, minutes):
    """Ticks a minute, an hour or five days apart, in small blocks."""
    df = spark.range(3500).select(
        F.lit("X").alias("symbol"), F.col("id").alias(T),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") * minutes).cast("int"))).alias("datetime"),
        (100 + F.pmod(F.xxhash64("id"), F.lit(20))).cast("double").alias("close"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40)) == 0).alias("bull"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(60)) == 0).alias("bear"))
    life = lc.lifecycle(df, block_rows=10).toPandas().sort_values("datetime")
    pdf = df.toPandas().sort_values("datetime")
    exp = brute.lifecycle([(d.to_pydatetime(), c, b, r) for d, c, b, r in zip(pdf["datetime"], pdf["close"], pdf["bull"], pdf["bear"])])
    assert list(life["kind"]) == [e["kind"] for e in exp] and any(e["kind"] for e in exp)
    assert list(life["live_after"]) == [e["live_after"] for e in exp]


def test_a_row_without_time_fails_loudly(spark):
    df = spark.createDataFrame([("X", None, 1.0)], "symbol string, datetime timestamp_ntz, close double")
    with pytest.raises(Exception, match="has no datetime"):
        with_row_index(df, 3_600_000_000).collect()


def test_a_later_flag_does_not_replace_a_live_signal(spark):
    """Golden case for CMP7: a bearish flag inside a live bullish signal."""
    rows = [(0, "2024-01-01 00:00", 100.0, True, False), (1, "2024-01-01 12:00", 99.0, False, True),
            (2, "2024-01-02 00:00", 95.0, False, False)]
    df = (spark.createDataFrame(rows, f"{T} long, datetime string, close double, bull boolean, bear boolean")
          .withColumn("datetime", F.col("datetime").cast("timestamp_ntz")).withColumn("symbol", F.lit("X")))
    states = lc.lifecycle(df).cache()
    live = lc.live_signals(states)
    assert [(r.close, r.diversions) for r in live.collect()] == [(100.0, 1)]
    got = lc.conversion_check(topn.newest(states), live).collect()
    assert [(r.signal_close, r.diversions, round(r.pct, 6), r.convert, r.expired) for r in got] == [(100.0, 1, 5.263158, 1, False)]
    # an idle symbol is not checked
    later = states.unionByName(states.limit(0))
    assert lc.conversion_check(topn.newest(later.where("kind = 0")), lc.live_signals(later.where("kind = 0"))).count() == 0


@pytest.mark.parametrize("exact", [False, True])
def test_warmup_rsi_over_gaps_equals_pandas(spark, exact):
    """One in twenty closes is missing, in runs too, from the start on, and across block edges."""
    import numpy as np
    import pandas as pd
    r = np.random.default_rng(7)
    n = 1500
    frames = []
    for s in ("A", "B"):
        close = 100 + np.cumsum(r.normal(0, 1, n))
        close[r.random(n) < 0.05] = np.nan
        close[300:330] = np.nan
        close[:2] = np.nan
        frames.append(pd.DataFrame({"symbol": s, "datetime": pd.date_range("2020-01-01", periods=n), "close": close}))
    pdf = pd.concat(frames, ignore_index=True)
    src = [(a, b.to_pydatetime(), None if np.isnan(c) else float(c)) for a, b, c in pdf.itertuples(index=False)]
    df = spark.createDataFrame(src, "symbol string, datetime timestamp_ntz, close double").withColumn(
        "open", F.col("close")).withColumn("high", F.col("close")).withColumn("low", F.col("close"))
    got = rsi_warmup(df, "1 day", block_rows=1024 if exact else 64, exact=exact).toPandas().sort_values(["symbol", "datetime"])
    for s, g in pdf.groupby("symbol"):
        mine = got[got.symbol == s].reset_index(drop=True)
        delta = g.close.diff().reset_index(drop=True)
        for name, x in (("AU", delta.clip(lower=0)), ("AD", delta.clip(upper=0).abs())):
            want = x.ewm(com=13, min_periods=14).mean()
            assert want.isna().tolist() == mine[name].isna().tolist()
            assert np.allclose(want.dropna(), mine[name].dropna(), rtol=1e-11, atol=0)
