"""Streaming equals batch; multi-batch state carry; replay is harmless."""

import datetime as dt
import math
import os

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from candlewick.operators.divergence import divergence_flags
from candlewick.operators.lifecycle import lifecycle
from candlewick.operators.resample import candles_from_ticks
from candlewick.operators.rsi import frame_rows, rsi_frame
from candlewick.sources.ticks import event_ticks
from candlewick.streaming import jobs
from candlewick.plans import sqlparts as Q
from candlewick.streaming.candles import admissions, landed_glob, measured_lag
from candlewick.streaming.jobs import (
    advance_batch, current_state, read_signals, run_candle_stream, run_folder, run_signal_stream, run_streams)
from tests.conftest import SF001, SF01
from tools.oracle_check import digest


def _split_events(spark, parts=4):
    """Write the sf0.001 events as several files in time order (one per batch)."""
    base = run_folder(spark, "split")
    src = os.path.join(base, "events")
    os.makedirs(src)
    t = pq.read_table(os.path.join(SF001, "events.parquet")).sort_by("ts")
    n = t.num_rows
    for i in range(parts):
        part = t.slice(i * n // parts, (i + 1) * n // parts - i * n // parts)
        pq.write_table(part, os.path.join(src, f"part-{i:03d}.parquet"))
        os.utime(os.path.join(src, f"part-{i:03d}.parquet"), (1_000_000 + i, 1_000_000 + i))
    return base, src


def test_stream_matches_batch_over_many_batches(spark):
    base, src = _split_events(spark)
    from candlewick.streaming.candles import event_tick_stream, land, stream_candles
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files a batch
    try:
        q = land(stream_candles(event_tick_stream(spark, src, max_files=1), "4 hours", "0 seconds"),
                 os.path.join(base, "candles"), os.path.join(base, "_ck1"))
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    landed = os.path.join(base, "candles")
    batches = [d for d in os.listdir(landed) if d.startswith("batch=")]
    assert len(batches) >= 3
    files = [os.path.join(landed, b, f) for b in batches for f in os.listdir(os.path.join(landed, b)) if f.endswith(".parquet")]
    assert len(files) > 2 * len(batches)
    for f in files:  # modification times say nothing about the order
        os.utime(f, (2_000_000, 2_000_000))
    out = run_signal_stream(spark, landed, base)
    s = read_signals(spark, out)
    assert read_signals(spark, out, late=True).count() == 0

    c = candles_from_ticks(event_ticks(spark, SF001), "4 hours")
    max_ts = event_ticks(spark, SF001).agg(F.max("ts")).first()[0]
    closed = c.where(F.col("datetime") + F.expr("INTERVAL 4 HOURS") <= F.lit(max_ts))
    r = rsi_frame(closed, "4 hours", block_rows=64, exact=True)
    life = lifecycle(divergence_flags(r, frame_rows(13, 64, True)), block_rows=64).drop("rsi")
    b = life.join(r.select("symbol", "datetime", "rsi", "up_ewma"), ["symbol", "datetime"])
    cols = ["symbol", "datetime", "up_ewma", "rsi", "bull", "bear", "kind", "live_after"]
    got = s.select(cols).toPandas().sort_values(["symbol", "datetime"]).reset_index(drop=True)
    exp = b.select(cols).toPandas().sort_values(["symbol", "datetime"]).reset_index(drop=True)
    assert len(got) == len(exp) == closed.count()
    assert (got.up_ewma == exp.up_ewma).all()  # same recursion, same bits
    for c_ in ["bull", "bear", "kind", "live_after"]:
        assert list(got[c_]) == list(exp[c_]), c_
    st = current_state(spark, base).toPandas().sort_values("symbol")
    last = exp.groupby("symbol").tail(1).sort_values("symbol")
    assert list(st["state"]) == [int(x) for x in last["live_after"]]
    # a batch that is replayed gives the same rows and the same state
    before = sorted(map(str, read_signals(spark, out).collect()))
    advance_batch(spark, base, len(batches) - 1, landed)
    assert sorted(map(str, read_signals(spark, out).collect())) == before
    assert current_state(spark, base).toPandas().sort_values("symbol")["close"].tolist() == st["close"].tolist()


def _candle_batch(spark, base, i, rows):
    df = spark.createDataFrame(rows, "symbol string, datetime string, close double")
    (df.select("symbol", F.col("datetime").cast("timestamp_ntz").alias("datetime"), *[F.col("close").alias(c) for c in (
        "open", "high", "low", "close", "volume", "QuoteAssetVolume")], F.lit(1).alias("NumTrades"))
     .write.parquet(os.path.join(base, "candles", f"batch={i:012d}")))


def test_late_and_corrected_candles_come_out_as_such(spark):
    base = run_folder(spark, "late")
    _candle_batch(spark, base, 0, [("X", "2024-01-01", 100.0), ("X", "2024-01-02", 101.0), ("X", "2024-01-04", 99.0)])
    _candle_batch(spark, base, 1, [("X", "2024-01-02", 101.0),    # delivered again
                                   ("X", "2024-01-04", 98.0),     # corrected
                                   ("X", "2024-01-03", 100.5),    # late
                                   ("X", "2024-01-05", 102.0), ("Y", "2024-01-01", 5.0)])
    out = run_signal_stream(spark, os.path.join(base, "candles"), base)
    late = read_signals(spark, out, late=True)
    assert sorted((str(r.datetime.date()), r.close) for r in late.collect()) == [("2024-01-03", 100.5), ("2024-01-04", 98.0)]
    assert late.where("rsi is not null").count() == 0
    rows = read_signals(spark, out).where("symbol = 'X'").orderBy("datetime").collect()
    assert [r.close for r in rows] == [100.0, 101.0, 99.0, 102.0] and read_signals(spark, out).count() == 5


def test_dropped_ticks_are_counted(spark):
    """Files out of time order: without a delay older ticks are dropped and
    counted, with enough delay none is."""
    import warnings

    base, src = _split_events(spark)
    for i in range(4):
        os.utime(os.path.join(src, f"part-{i:03d}.parquet"), (1_000_000 - i, 1_000_000 - i))
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        run_candle_stream(spark, src, "4 hours", base=os.path.join(base, "a"), max_files=1)
    n = spark.read.parquet(os.path.join(base, "a", "dropped")).first().dropped
    assert n > 0 and any(str(n) in str(w.message) for w in said)
    run_candle_stream(spark, src, "4 hours", "400 days", os.path.join(base, "b"), max_files=1)
    assert spark.read.parquet(os.path.join(base, "b", "dropped")).first().dropped == 0


def test_streams_follow_each_landed_batch(spark):
    _, src = _split_events(spark)
    many = run_streams(spark, src, max_files=1)
    one = run_streams(spark, src, max_files=100)
    assert many.count() == one.count() > 0
    assert many.exceptAll(one).count() == 0


def test_candle_stream_holds_open_windows(spark):
    out = run_candle_stream(spark, os.path.join(SF001, "events.parquet"), "1 day")
    n = spark.read.parquet(landed_glob(out)).count()
    total = candles_from_ticks(event_ticks(spark, SF001), "1 day").count()
    assert n == total - 5  # the newest window of each of the 5 symbols is still open


def _unordered_events(spark, parts=150):
    """An sf folder whose events are three batches of files, each with ticks of any time."""
    sf = run_folder(spark, "unordered")
    src = os.path.join(sf, "events.parquet")
    os.makedirs(src)
    t = pq.read_table(os.path.join(SF001, "events.parquet"))
    for i in range(parts):
        part = os.path.join(src, f"part-{i:03d}.parquet")
        pq.write_table(t.take(list(range(parts - 1 - i, t.num_rows, parts))), part)
        os.utime(part, (1_000_000 + i // 3, 1_000_000 + i // 3))
    return sf


def test_queries_over_many_unordered_files_match_the_sql(spark):
    sf = _unordered_events(spark)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{sf}/events.parquet/*.parquet'")
    for name in ("stream_candles", "stream_rsi", "stream_lifecycle"):
        got = E.queries()[name](spark, sf).toPandas()
        exp = con.sql(E.oracle_sql()[name]).df()
        assert len(got) == len(exp) > 0, name
        assert digest(got) == digest(exp), name


def test_measured_lag(spark):
    """Files in time order need no delay, those against it the span from the
    oldest to the newest; files of one modification time have no order."""
    _, src = _split_events(spark)
    files = [os.path.join(src, f"part-{i:03d}.parquet") for i in range(4)]
    newest, lag = measured_lag(spark, src)
    assert lag == 0 and newest == event_ticks(spark, SF001).agg(F.unix_millis(F.max("ts").cast("timestamp"))).first()[0]
    for i, f in enumerate(files):
        os.utime(f, (1_000_000 - i, 1_000_000 - i))
    span = pq.read_table(files[0])["ts"].to_pandas().min(), pq.read_table(files[-1])["ts"].to_pandas().max()
    _, backward = measured_lag(spark, src)
    assert 0 < backward - (span[1] - span[0]).total_seconds() * 1000 <= 2
    for f in files:
        os.utime(f, (1_000_000, 1_000_000))
    assert measured_lag(spark, src)[1] == backward


def test_whole_table_fails_on_dropped_ticks(spark, monkeypatch):
    _, src = _split_events(spark)
    for i in range(4):
        os.utime(os.path.join(src, f"part-{i:03d}.parquet"), (1_000_000 - i, 1_000_000 - i))
    real = jobs.admissions
    monkeypatch.setattr(jobs, "admissions", lambda *a: ([(names, 0) for names, _ in reversed(real(*a)[0])], True))
    with pytest.raises(RuntimeError, match="dropped"):
        run_candle_stream(spark, src, "4 hours", delay=None, max_files=1)


def test_drops_of_all_batches_are_counted(spark):
    """Also those whose progress entry the query no longer keeps."""
    base, src = _split_events(spark, 6)
    for i in range(6):
        os.utime(os.path.join(src, f"part-{i:03d}.parquet"), (1_000_000 - i, 1_000_000 - i))
    seen = []
    for kept in ("100", "2"):  # with 2, Spark keeps one entry
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
        try:
            with pytest.warns(UserWarning, match="dropped"):
                run_candle_stream(spark, src, "4 hours", base=os.path.join(base, kept), max_files=1)
        finally:
            spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        seen.append(spark.read.parquet(os.path.join(base, kept, "dropped")).first().dropped)
    assert seen[0] == seen[1] > 0


def test_state_is_bounded_by_the_overlap_of_files(spark):
    """Two hundred files written in no order, each of a stretch of time that
    overlaps its neighbours': the SQL's candles, and a state that holds few
    files' ticks instead of the table's."""
    sf = run_folder(spark, "stretches")
    src = os.path.join(sf, "events.parquet")
    os.makedirs(src)
    t = pq.read_table(os.path.join(SF01, "events.parquet")).sort_by("ts")
    n, step = t.num_rows, t.num_rows / 200
    for i in range(200):
        # two of three rows of the own stretch, the third of the stretch before
        own = [k for k in range(int(i * step), int((i + 1) * step)) if k % 3 or i == 199]
        before = [k for k in range(int((i - 1) * step), int(i * step)) if k % 3 == 0] if i else []
        at = os.path.join(src, f"part {(i * 37) % 200:03d},{{x}}.parquet")
        pq.write_table(t.take(before + own), at)
        os.utime(at, (1_000_000 + (i * 61) % 200 * 864_000,) * 2)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{src}/*.parquet'")
    assert con.sql("SELECT count(*) FROM events").fetchall()[0][0] == n
    steps, ends = admissions(spark, src, 25)
    assert ends and [len(names) for names, _ in steps] == [25] * 8 and steps[-1][1] == 0
    assert sorted(x for names, _ in steps for x in names) == sorted(os.listdir(src))
    base = run_folder(spark, "overlap")
    out = run_candle_stream(spark, src, "1 hour", None, base, max_files=25)
    got = spark.read.parquet(landed_glob(out)).select("symbol", "datetime", "open", "close", "NumTrades").toPandas()
    closed = "datetime + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) FROM events)"
    exp = con.sql(f"SELECT symbol, datetime, open, close, NumTrades FROM ({Q.candles(Q.EVENT_TICKS, '1 hour')}) WHERE {closed}").df()
    assert len(got) == len(exp) > 0 and digest(got) == digest(exp)
    held = [r.state_rows for r in spark.read.parquet(os.path.join(base, "dropped")).collect()]
    ticks_a_step = n / 8
    assert len(held) == 8 and 0 < max(held) < 1.7 * ticks_a_step  # one batch and an overlap, dedupe rows and windows


def _hot_batches(n=2600):
    """Two batches of hourly candles: a hot symbol, one that is new in the second,
    and candles that come again, late or corrected."""
    rows = lambda s, a, b: [(s, f"{(d := dt.datetime(2020, 1, 1) + dt.timedelta(hours=i))}",
                             round(100 + 25 * math.sin(i / 11) + (i * 7919 % 101) / 20, 3)) for i in range(a, b)]
    one = rows("H", 0, n) + rows("B", 0, 20)
    two = rows("H", n, 2 * n) + rows("B", 20, 25) + rows("N", 0, 45)
    again = rows("H", n - 3, n)[:2] + rows("B", 3, 4) + rows("H", n + 5, n + 6)
    corrected = [("H", again[0][1], 1.5), ("H", str(dt.datetime(2019, 5, 1)), 7.0), ("N", rows("N", 4, 5)[0][1], 3.25)]
    return one, two + again + corrected


def test_a_hot_symbol_in_blocks_gives_the_same_rows_and_state(spark):
    made = {}
    batches = _hot_batches()
    for group_rows in (10**9, 500):
        base = run_folder(spark, "hot")
        for i, rows in enumerate(batches):
            _candle_batch(spark, base, i, rows)
            advance_batch(spark, base, i, os.path.join(base, "candles"), group_rows=group_rows)
        s = read_signals(spark, os.path.join(base, "signals"))
        late = read_signals(spark, os.path.join(base, "signals"), late=True)
        state = spark.read.parquet(os.path.join(base, "state", "batch=000000000001"))
        made[group_rows] = [sorted(map(str, s.collect())), sorted(r.close for r in late.where("symbol = 'H'").collect()),
                            late.count(), sorted(map(str, state.collect()))]
    a, b = made.values()
    assert len(a[0]) == len(b[0]) == 5200 + 25 + 45
    assert [x for x in a[0] if "'N'" not in x] == [x for x in b[0] if "'N'" not in x]  # the same bits
    assert a[1] == b[1] == [1.5, 7.0] and a[2] == b[2] == 3  # H twice, N's second version
    assert [x for x in a[3] if "'N'" not in x] == [x for x in b[3] if "'N'" not in x]
    assert any("kind=1" in x for x in a[0]) and any("kind=2" in x for x in a[0])


def test_a_hot_symbol_is_several_tasks(spark, monkeypatch):
    from candlewick.operators import ewma
    from candlewick.streaming import blocked
    seen = []
    real = ewma.exact_fold
    monkeypatch.setattr(blocked, "exact_fold", lambda df, *a: seen.append(df) or real(df, *a))
    base = run_folder(spark, "hot")
    one, _ = _hot_batches(8000)
    _candle_batch(spark, base, 0, one)
    advance_batch(spark, base, 0, os.path.join(base, "candles"), group_rows=500)
    blocks = seen[0].where("symbol = 'H'").select("_blk", F.spark_partition_id().alias("task")).distinct().collect()
    assert len({r["_blk"] for r in blocks}) >= 4 and len({r.task for r in blocks}) >= 3


def test_signals_on_streaming_state_equal_the_state_table(spark):
    """``stream_signals`` keeps the state in Structured Streaming: the same rows."""
    from candlewick.streaming.candles import CANDLE_STREAM_SCHEMA
    from candlewick.streaming.signals import stream_signals
    base = run_folder(spark, "state")
    for i, rows in enumerate(_hot_batches(120)):
        _candle_batch(spark, base, i, rows)
        advance_batch(spark, base, i, os.path.join(base, "candles"))
        folder = os.path.join(base, "candles", f"batch={i:012d}")
        for f in os.listdir(folder):
            os.utime(os.path.join(folder, f), (1_000_000 + i, 1_000_000 + i))
    files = [len([f for f in os.listdir(os.path.join(base, "candles", d)) if f.endswith(".parquet")])
             for d in sorted(os.listdir(os.path.join(base, "candles")))]
    stream = (spark.readStream.schema(CANDLE_STREAM_SCHEMA).option("maxFilesPerTrigger", files[0])
              .parquet(os.path.join(base, "candles", "batch=*")))
    q = (stream_signals(stream).writeStream.format("parquet").option("path", os.path.join(base, "out"))
         .option("checkpointLocation", os.path.join(base, "_ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(os.path.join(base, "out")).where("symbol <> 'N'")
    exp = read_signals(spark, os.path.join(base, "signals")).where("symbol <> 'N'")
    assert sorted(map(str, got.where("NOT late").select(exp.columns).collect())) == sorted(map(str, exp.collect()))
    assert sorted(r.close for r in got.where("late").collect()) == [1.5, 7.0]
