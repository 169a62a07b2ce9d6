"""Sinks and pipelines: table writes, idempotent upsert, backfill, daily state."""

import os

import pytest
from pyspark.sql import functions as F

from candlewick import schema as S
from candlewick.operators.resample import candles_from_ticks
from candlewick.plans.jobs import backfill, backfill_candles, daily, daily_tick, replay_state
from candlewick.session import materialize
from candlewick.sinks.messages import kafka_frame, to_json_messages
from candlewick.sinks.tables import append_table, overwrite_table, read_state, read_table, read_upserted, upsert_state
from candlewick.sources.klines import decode_kline_payload, kline_rejects, read_csv_candles
from candlewick.sources.literal import state_frame
from candlewick.sources.ticks import event_ticks, tick_rejects
from candlewick.streaming.jobs import run_folder
from tests.conftest import SF001


def test_backfill_writes_tables(spark):
    out = run_folder(spark, "backfill")
    paths = backfill(spark, event_ticks(spark, SF001), out, "4 hours", block_rows=64)
    k = spark.read.parquet(paths["klines"])
    r = spark.read.parquet(paths["klines_rsi"])
    assert k.count() == r.count() > 0
    assert set(S.RSI_COLUMNS) <= set(r.columns)
    assert any(x.startswith("symbol=") for x in os.listdir(paths["klines"]))
    inner = os.path.join(paths["klines"], "symbol=view")
    assert any(x.startswith("month=") for x in os.listdir(inner))


def test_a_hot_symbol_is_written_by_many_tasks(spark):
    out = os.path.join(run_folder(spark, "hot"), "t")
    df = spark.range(400).select(F.lit("X").alias("symbol"), (
        F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("id").cast("int"))).alias("datetime"),
        F.col("id").cast("double").alias("close"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        overwrite_table(df, out)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    names = {f.split("-")[1] for d, _, fs in os.walk(out) for f in fs if f.endswith(".parquet")}
    assert len(names) >= 4  # part numbers: tasks
    assert read_table(spark, out).count() == 400


def test_state_upsert_keeps_other_keys_and_compacts(spark):
    path = os.path.join(run_folder(spark, "state"), "s")
    assert read_state(spark, path) is None
    for rows in ([("a", 0), ("b", 0)], [("b", 1), ("c", 1)], [("a", 1)], [("c", 0)]):
        upsert_state(spark, path, spark.createDataFrame(rows, "symbol string, state long"))
    assert {tuple(r) for r in read_state(spark, path).collect()} == {("a", 1), ("b", 1), ("c", 0)}
    assert sorted(x for x in os.listdir(path) if x.startswith("v")) == ["version=000000000003", "version=000000000004"]
    # a version that was not completed is not read
    os.makedirs(os.path.join(path, "version=000000000005"))
    assert read_state(spark, path).count() == 3


def test_dirty_klines_fail_or_are_shown(spark):
    good = '[[1704067200000,"1","2","0.5","1.5","10",1,"20",3,"0","0","0"]'
    p = spark.createDataFrame([("X", good + "]"), ("Y", good + ',[1704067200000,"oops","2","0.5","1.5","10",1,"20",3,"0","0","0"]]'),
                               ("Z", "no json"), ("W", good + ',[17,"1"]]')], "symbol string, payload string")
    with pytest.raises(Exception, match="does not decode"):
        decode_kline_payload(p).collect()
    assert decode_kline_payload(p.where("symbol = 'X'")).count() == 1
    assert sorted(r.symbol for r in kline_rejects(p).collect()) == ["W", "Y", "Z"]
    soft = decode_kline_payload(p, strict=False, rejected="bad").collect()
    assert len(soft) == 6 and sum(r.bad for r in soft) == 3
    assert [r.close for r in soft if r.symbol == "Y" and r.bad] == [1.5]


def test_tick_rejects(spark):
    df = spark.createDataFrame([("X", "2024-01-01", 1.0), ("X", None, 2.0), ("X", "2024-01-02", None)], "s string, t string, p double")
    assert tick_rejects(df, "t", "p").count() == 2


def test_daily_ticks_equal_the_replay_of_their_state(spark):
    """Several ticks in a row: the stored state follows the tick rule, and a
    tick that arrives twice changes nothing."""
    c = candles_from_ticks(event_ticks(spark, SF001), "4 hours").where("datetime < '2024-01-12'").cache()
    times = [r[0] for r in c.select("datetime").distinct().orderBy("datetime").collect()]
    out = run_folder(spark, "ticks")
    backfill_candles(spark, c.where(F.col("datetime") < F.lit(times[-3])), out, "4 hours", 64)
    replay_state(spark, out, "4 hours", 64)
    for t in times[-3:]:
        got = daily_tick(spark, out, c.where(F.col("datetime") == F.lit(t)), "4 hours")
        assert got.count() == c.where(F.col("datetime") == F.lit(t)).count()
        state = {r.symbol: r for r in read_state(spark, os.path.join(out, "state")).collect()}
        for r in got.collect():
            assert state[r.symbol].state == int(r.live_after)
            assert (r.kind > 0) or not r.live_after
    again = daily_tick(spark, out, c.where(F.col("datetime") == F.lit(times[-1])), "4 hours")
    assert again.count() == 0
    assert read_table(spark, os.path.join(out, "klines_rsi")).count() == c.count()


def test_dynamic_overwrite_keeps_other_symbols(spark):
    out = os.path.join(run_folder(spark, "ovw"), "t")
    c = candles_from_ticks(event_ticks(spark, SF001), "1 day")
    overwrite_table(c, out)
    n = spark.read.parquet(out).count()
    overwrite_table(c.where("symbol = 'view'").withColumn("close", F.lit(1.0)), out)
    after = spark.read.parquet(out)
    assert after.count() == n
    assert after.where("symbol = 'view' AND close != 1.0").count() == 0
    assert after.where("symbol != 'view' AND close = 1.0").count() == 0


def test_append_then_upsert_read_is_idempotent(spark):
    out = os.path.join(run_folder(spark, "ups"), "t")
    c = candles_from_ticks(event_ticks(spark, SF001), "1 day").withColumn("ingested_at", F.col("datetime"))
    append_table(c, out)
    append_table(c, out)  # a re-delivered batch
    later = c.withColumn("ingested_at", F.col("datetime") + F.expr("INTERVAL 1 HOUR")).withColumn("close", F.lit(2.0))
    append_table(later, out)
    got = read_upserted(spark, out, ["symbol", "datetime"], "ingested_at")
    assert got.count() == c.count()
    assert got.where("close != 2.0").count() == 0


def test_daily_state_and_messages(spark):
    c = candles_from_ticks(event_ticks(spark, SF001), "4 hours")
    d = daily(c, "4 hours", block_rows=64)
    assert d.count() == 5
    assert set(r.state for r in d.collect()) <= {0, 1}
    msgs = to_json_messages(d.select("datetime", "symbol", "close", "kind")).collect()
    assert all(m.value.startswith("{") for m in msgs)
    kf = kafka_frame(d.select("symbol", "close"))
    assert kf.columns == ["key", "value"]
    assert state_frame(spark, 1).collect()[0].state == 1


def test_job_command_line(spark):
    from candlewick.plans.jobs import _main
    out = run_folder(spark, "cli")
    _main(["backfill", "--input", os.path.join(SF001, "events.parquet"), "--out", out, "--interval", "4 hours"])
    _main(["daily", "--input", os.path.join(out, "klines"), "--out", out, "--interval", "4 hours"])
    state = spark.read.parquet(os.path.join(out, "daily"))
    assert state.count() == 5 and "state" in state.columns
    stored = {r.symbol: r.state for r in read_state(spark, os.path.join(out, "state")).collect()}
    assert stored == {r.symbol: r.state for r in state.collect()}
    with pytest.raises(SystemExit):  # a stream needs to be told its delay
        _main(["stream", "--input", "x", "--out", out])


def test_missed_days_and_a_failed_run_are_taken_up(spark):
    """Several new candles of a symbol, some already stored without RSI row,
    give the rows and the state of single ticks."""
    c = materialize(candles_from_ticks(event_ticks(spark, SF001), "4 hours"))
    times = [r[0] for r in c.select("datetime").distinct().orderBy("datetime").collect()][-3:]
    tables, ticks = [], []
    for single in (True, False):
        out = run_folder(spark, "missed")
        backfill_candles(spark, c.where(F.col("datetime") < F.lit(times[0])), out, "4 hours")
        replay_state(spark, out, "4 hours")
        if single:
            got = [r for t in times for r in daily_tick(spark, out, c.where(F.col("datetime") == F.lit(t)), "4 hours").collect()]
        else:
            klines = os.path.join(out, "klines")
            first = c.where(F.col("datetime") == F.lit(times[0])).select(*read_table(spark, klines).columns)
            append_table(first, klines, by="month")  # where a run failed
            got = daily_tick(spark, out, c.where(F.col("datetime") >= F.lit(times[0])), "4 hours").collect()
        ticks.append(sorted(map(str, got)))
        tables.append([sorted(map(str, read_table(spark, os.path.join(out, t)).collect())) for t in ("klines", "klines_rsi")]
                      + [sorted(map(str, read_state(spark, os.path.join(out, "state")).collect()))])
    assert ticks[0] == ticks[1] and len(ticks[0]) == c.where(F.col("datetime") >= F.lit(times[0])).count() > 5
    assert tables[0] == tables[1]
    with pytest.raises(ValueError, match="older"):
        daily_tick(spark, out, c.limit(1).withColumn("datetime", F.col("datetime") - F.expr("INTERVAL 1 HOUR")), "4 hours")


def write_file(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_columns_are_found_by_name(spark):
    out = run_folder(spark, "csv")
    write_file(out, "a.csv", "datetime,open,high,low,close,volume,NumTrades\n2024-01-01,1,4,0.5,2,10,3\n2024-01-02,,4,1,3,10,\n")
    write_file(out, "b c.csv", '\ufeff"note","close","open",NumTrades,low,high, volume ,datetime\n"x, ""y""",2,1,3,0.5,4,10,2024-01-03\n')
    write_file(out, "c.csv", "datetime,open,high,low,close,volume,NumTrades\n")
    got = sorted(map(tuple, read_csv_candles(spark, out, "X").select("datetime", "open", "high", "low", "close", "volume", "NumTrades", "symbol").collect()))
    assert [(r[0].day, *r[1:]) for r in got] == [(1, 1.0, 4.0, 0.5, 2.0, 10.0, 3, "X"), (2, None, 4.0, 1.0, 3.0, 10.0, None, "X"),
                                                 (3, 1.0, 4.0, 0.5, 2.0, 10.0, 3, "X")]
    one = read_csv_candles(spark, os.path.join(out, "b c.csv"))
    assert [(r.open, r.close) for r in one.collect()] == [(1.0, 2.0)]


def test_csv_rows_that_do_not_parse(spark):
    out = run_folder(spark, "csv")
    head = "datetime,open,high,low,close,volume,NumTrades\n"
    write_file(out, "a.csv", head + "2024-01-01,1,4,0.5,n/a,10,3\nsoon,1,4,0.5,2,10,3\n2024-01-03,1,4,0.5,2,10\n"
               "2024-01-04,1,4,0.5,2,10,3,9\n2024-01-05,1,4,0.5,2,10,3\n,1,4,0.5,2,10,3\n2024-01-06,1,4,0.5,2,10,3.5\n")
    with pytest.raises(Exception, match="does not parse"):
        read_csv_candles(spark, out).collect()
    got = read_csv_candles(spark, out, strict=False, rejected="bad").collect()
    assert len(got) == 7 and [r.datetime.day for r in got if not r.bad] == [5]
    assert [r.close for r in got if r.bad and r.datetime and r.datetime.day == 1] == [None]
    assert read_csv_candles(spark, out, strict=False).columns == [f.name for f in S.CSV_CANDLE_SCHEMA.fields]
    for bad in ("datetime,open\n", "datetime,close,close,open,high,low,volume,NumTrades\n", "1,2,3\n"):
        other = run_folder(spark, "csv")
        write_file(other, "a.csv", bad + "2024-01-01,1\n")
        with pytest.raises(ValueError):
            read_csv_candles(spark, other)
