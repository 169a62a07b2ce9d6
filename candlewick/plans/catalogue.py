"""Query catalogue: one Spark plan and one DuckDB oracle per operator ID.

Every query reads the driver tables (``events`` as the tick stream,
``orders`` as a long daily series) and runs over whole tables.  Double
columns are rounded to 6 digits on both sides; columns are aliased to the
same names on both sides.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import schema as S
from candlewick.functions.indicators import (
    gain_keep_null, interval_micros, loss_keep_null)
from candlewick.functions.timefn import epoch_ms_to_ts, utc_to_wall_clock
from candlewick.operators import divergence as dv
from candlewick.operators import lifecycle as lc
from candlewick.operators import topn
from candlewick.operators.ewma import ewma
from candlewick.operators.resample import candles_from_ticks, resample_candles
from candlewick.operators.rsi import frame_rows, rsi_frame, rsi_tail, rsi_warmup, with_gains
from candlewick.operators.sequence import OWN, blocks_with_halo, with_row_index
from candlewick.plans import sqlparts as Q
from candlewick.plans.jobs import (backfill, backfill_candles, correct_candles, daily_tick, replay_state,
                                   stage_tick)
from candlewick.plans.feeds import INTERVALS, fed_candles, feed_ticks
from candlewick.session import materialize, materialize_by
from candlewick.sources.klines import decode_kline_payload, pack_kline_payload, read_kline_payloads, read_klines
from candlewick.sources.literal import state_frame
from candlewick.sources.tables import table
from candlewick.sources.ticks import event_ticks, order_ticks
from candlewick.sinks.messages import kafka_frame, parse_messages, to_json_messages
from candlewick.sinks.tables import overwrite_table, read_state, read_table, upsert_state
from candlewick.streaming.candles import landed_glob
from candlewick.streaming.jobs import run_candle_stream, run_folder, run_streams

# Rows per block for the catalogue.  The long daily series (orders, ~2,400
# rows per symbol) spans three blocks, so the sf0.01 check runs every
# block-edge path; 1,024 rows leave room for the exact-fold warm-up (600).
BLOCK = 1024

CANDLE_COLS = S.CANDLE_COLUMNS
CANDLE_DBL = {"open", "high", "low", "close", "volume", "QuoteAssetVolume"}


@dataclass
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    cols: list[str]
    doubles: set[str]
    sql: str | None = None
    ids: str = ""

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        # wall-clock arithmetic (KST shift, epoch ms, elapsed days) assumes UTC
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = self.build(spark, sf_dir)
        return df.select(*[F.round(F.col(c), 6).alias(c) if c in self.doubles else F.col(c)
                           for c in self.cols])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        sel = ", ".join(f"round({c}, 6) AS {c}" if c in self.doubles else c for c in self.cols)
        return f"SELECT {sel} FROM ({self.sql}) AS _q"


# ---------------------------------------------------------------- inputs

def _candles(spark, sf, interval):
    return candles_from_ticks(event_ticks(spark, sf), interval)


def _daily_orders(spark, sf):
    return candles_from_ticks(order_ticks(spark, sf), "1 day")


def _rsi_rows(spark, sf, interval, block=BLOCK, src=None, exact=False):
    c = src if src is not None else _candles(spark, sf, interval)
    return rsi_frame(c, interval, block_rows=block, exact=exact)


def _keep(df):
    """Bucketed table in the checkpoint folder, partitioned like the blocks,
    for plans that read a frame more than once."""
    return materialize_by(df, ["symbol", "_blk"], ["symbol", "_blk", "_t"])


def _flags(spark, sf, interval="4 hours", block=BLOCK, src=None, keep=False):
    # flags compare RSI values with each other: the exact fold
    r = _keep(_rsi_rows(spark, sf, interval, block, src, exact=True))
    f = dv.divergence_flags(r, frame_rows(S.COM, block, True))
    return _keep(f) if keep else f


def _life(spark, sf, interval="4 hours", block=BLOCK, src=None):
    return lc.lifecycle(_flags(spark, sf, interval, block, src, keep=True),
                        block_rows=frame_rows(S.COM, block, True), block_col="_blk")


C1H = Q.candles(Q.EVENT_TICKS, "1 hour")
C4H = Q.candles(Q.EVENT_TICKS, "4 hours")
C1D = Q.candles(Q.EVENT_TICKS, "1 day")
O1D = Q.candles(Q.ORDER_TICKS, "1 day")

RSI_DBL = {"open", "high", "low", "close", "up_ewma", "down_ewma", "rsi"}
LIFE_COLS = ["datetime", "symbol", "close", "bull", "bear", "kind", "signal_datetime",
             "signal_close", "pct", "converted", "age_days", "live_after"]
LIFE_DBL = {"close", "signal_close", "pct"}
FLAG_COLS = ["symbol", "datetime", "close", "low", "high", "rsi"]
FLAG_DBL = {"close", "low", "high", "rsi"}

# ---------------------------------------------------------------- builders


def _delta_gain_loss(spark, sf):
    c = _candles(spark, sf, "1 hour")
    seq = with_row_index(c, interval_micros("1 hour") * BLOCK)
    g = with_gains(blocks_with_halo(seq, BLOCK, 1), "symbol").where(F.col(OWN))
    return g.withColumn("ups_nb", gain_keep_null("delta")).withColumn("downs_nb", loss_keep_null("delta"))


def _dedupe(spark, sf):
    """SNK2 upsert over a kline log in which every hourly candle arrives twice:
    first as the still-open snapshot taken at half past the hour (built from
    that hour's ticks so far), then as the closed candle from all of its
    ticks.  The log covers every tick; keeping the newest version per
    (symbol, datetime) must return exactly the closed candles."""
    t = event_ticks(spark, sf)
    first_half = t.where(F.minute("ts") < 30)
    partial = candles_from_ticks(first_half, "1 hour").withColumn(
        "ingested_at", F.col("datetime") + F.expr("INTERVAL 30 MINUTES"))
    final = candles_from_ticks(t, "1 hour").withColumn(
        "ingested_at", F.col("datetime") + F.expr("INTERVAL 1 HOUR"))
    return topn.dedupe_latest(partial.unionByName(final), ["symbol", "datetime"], "ingested_at")


def _kline_json(spark, sf):
    c = _candles(spark, sf, "1 hour")
    return decode_kline_payload(pack_kline_payload(c, "1 hour"), tz=S.EXCHANGE_TZ)


def _conversion(spark, sf):
    """The check as of the newest tick on which any symbol has a live signal
    (at the end of a table all symbols may be idle)."""
    life = materialize(_life(spark, sf))
    as_of = life.where("kind > 0").agg(F.max("datetime").alias("as_of"))
    seen = life.join(F.broadcast(as_of), F.col("datetime") <= F.col("as_of"))  # one row
    return lc.conversion_check(topn.newest(seen), lc.live_signals(seen))


def _state(spark, sf):
    """The state table as the jobs keep it: every symbol starts from the
    literal state 0, then symbols whose newest tick has a live signal are
    upserted, and the table is read back."""
    path = os.path.join(run_folder(spark, "state"), "state")
    symbols = event_ticks(spark, sf).select("symbol").distinct()
    upsert_state(spark, path, symbols.join(F.broadcast(state_frame(spark, 0)), how="cross"))  # one literal row
    live = topn.newest(_life(spark, sf)).where("live_after")
    upsert_state(spark, path, live.select("symbol", F.lit(1).cast("bigint").alias("state")))
    return read_state(spark, path)


def _backfilled(spark, sf):
    """PIPE2 over the daily orders; the stored RSI table, read back."""
    out = run_folder(spark, "backfill")
    return read_table(spark, backfill(spark, order_ticks(spark, sf), out, "1 day")["klines_rsi"])


def _klines_table(spark, sf):
    """SNK1 then SRC3: candles as the 12-column kline table, written, one
    symbol's rows written again, read with the fixed schema."""
    path = os.path.join(run_folder(spark, "klines"), "klines")
    c = _candles(spark, sf, "1 hour").select(
        F.col("datetime").cast("timestamp").alias("datetime"), *CANDLE_COLS[:1], *CANDLE_COLS[2:],
        F.lit(0.0).alias("TakerBuyBaseAssetVolume"), F.lit(0.0).alias("TakerBuyQuoteAssetVolume"),
        F.lit("0").alias("Ignore"))
    overwrite_table(c, path)
    overwrite_table(c.where("symbol = 'view'"), path)
    return read_klines(spark, path).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


def _responses(spark, sf):
    """SRC1 from landed files: hourly candles as exchange responses, one JSON
    line each, with malformed values (close of candles of 7, 14, ... trades,
    open time of 11, 22, ...), written, read, decoded with rejects marked."""
    path = os.path.join(run_folder(spark, "responses"), "landed")
    p = pack_kline_payload(_candles(spark, sf, "1 hour"), "1 hour")
    k = F.from_json("payload", "array<array<string>>")
    dirty = F.transform(k, lambda e: F.transform(e, lambda v, i: F.when(
        (i == 4) & (F.pmod(e[8].cast("int"), F.lit(7)) == 0), F.lit("n/a")).when(
        (i == 0) & (F.pmod(e[8].cast("int"), F.lit(11)) == 0), F.lit("")).otherwise(v)))
    p.select(F.to_json(F.struct("symbol", dirty.alias("payload")))).write.text(path)
    return decode_kline_payload(read_kline_payloads(spark, path), strict=False, rejected="rejected")


def _daily_tick(spark, sf):
    """PIPE1 against backfilled tables: all but each symbol's newest daily
    candle are backfilled, then the newest arrive as one tick."""
    c = materialize(_daily_orders(spark, sf))
    new = topn.newest(c)
    out = run_folder(spark, "tick")
    backfill_candles(spark, c.join(new, ["symbol", "datetime"], "left_anti"), out, "1 day")
    replay_state(spark, out, "1 day")
    return daily_tick(spark, out, new)


def _tick_recovery(spark, sf):
    """PIPE1 with a job that dies: the newest candles' tables are written, but
    the job ends before its commit.  A second job runs the same tick; the
    stored ticks of the newest candles are read back."""
    c = materialize(_daily_orders(spark, sf))
    new = topn.newest(c)
    out = run_folder(spark, "recovery")
    backfill_candles(spark, c.join(new, ["symbol", "datetime"], "left_anti"), out, "1 day")
    replay_state(spark, out, "1 day")
    stage_tick(spark, out, new)
    daily_tick(spark, out, new)
    return topn.newest(read_table(spark, os.path.join(out, "ticks")))


def _corrected(spark, sf):
    """A backfill of candles of which about one in a hundred is wrong and one in
    two hundred is missing, then the true candles arrive as corrections."""
    c = materialize(_daily_orders(spark, sf))
    newest = topn.newest(c).select("symbol", F.col("datetime").alias("_newest"))
    draw = F.pmod(F.xxhash64("symbol", "datetime"), F.lit(200))
    was = c.join(newest, "symbol").withColumn("_draw", F.when(F.col("datetime") < F.col("_newest"), draw).otherwise(9))
    for x in ("open", "high", "low", "close"):
        was = was.withColumn(x, F.when(F.col("_draw") < 2, F.col(x) * 1.25).otherwise(F.col(x)))
    out = run_folder(spark, "corrected")
    backfill_candles(spark, was.where("_draw <> 2").select(*c.columns), out, "1 day")
    replay_state(spark, out, "1 day", BLOCK)
    correct_candles(spark, out, c, "1 day", BLOCK)
    return out


def _daily(spark, sf):
    life = _life(spark, sf, "1 day", 2048, _daily_orders(spark, sf))
    return topn.newest(life)


QUERIES: dict[str, Query] = {
    "candles_1h": Query(lambda s, d: _candles(s, d, "1 hour"), CANDLE_COLS, CANDLE_DBL, C1H, "RES3"),
    "candles_4h": Query(lambda s, d: _candles(s, d, "4 hours"), CANDLE_COLS, CANDLE_DBL, C4H, "RES1"),
    "candles_1d": Query(lambda s, d: _candles(s, d, "1 day"), CANDLE_COLS, CANDLE_DBL, C1D, "RES2"),
    "resample_1h_to_4h": Query(
        lambda s, d: resample_candles(_candles(s, d, "1 hour"), "4 hours"), CANDLE_COLS, CANDLE_DBL,
        "SELECT symbol, time_bucket(INTERVAL '4 hours', datetime) AS datetime, "
        "arg_min(open, datetime) AS open, max(high) AS high, min(low) AS low, "
        "arg_max(close, datetime) AS close, sum(volume) AS volume, "
        "sum(QuoteAssetVolume) AS QuoteAssetVolume, CAST(sum(NumTrades) AS INTEGER) AS NumTrades "
        f"FROM ({C1H}) GROUP BY 1, 2", "RES1"),
    "closed_candle_latest": Query(
        lambda s, d: topn.closed_latest(_candles(s, d, "1 day")), CANDLE_COLS, CANDLE_DBL,
        f"SELECT * FROM ({C1D}) QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) = 2",
        "SRC2"),
    "kline_dedupe_latest": Query(
        _dedupe, CANDLE_COLS + ["ingested_at"], CANDLE_DBL,
        "SELECT * FROM ("
        f"SELECT *, datetime + INTERVAL 30 MINUTE AS ingested_at FROM ("
        f"{Q.candles(Q.EVENT_TICKS + ' AND minute(ts) < 30', '1 hour')}) "
        f"UNION ALL SELECT *, datetime + INTERVAL 1 HOUR AS ingested_at FROM ({C1H})) "
        "QUALIFY row_number() OVER (PARTITION BY symbol, datetime ORDER BY ingested_at DESC) = 1",
        "SNK2"),
    "kst_shift": Query(
        lambda s, d: table(s, d, "events").select(
            "event_id", "ts", utc_to_wall_clock("ts", S.EXCHANGE_TZ).alias("kst")),
        ["event_id", "ts", "kst"], set(),
        "SELECT event_id, ts, ts + INTERVAL 9 HOUR AS kst FROM events", "DT2"),
    "epoch_ms_decode": Query(
        lambda s, d: table(s, d, "events").select(
            "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
        .withColumn("decoded", epoch_ms_to_ts("ms")),
        ["event_id", "ms", "decoded"], set(),
        "SELECT event_id, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS ms, "
        "epoch_ms(CAST(floor(epoch_us(ts) / 1000) AS BIGINT)) AS decoded FROM events", "DT1"),
    "kline_json_decode": Query(
        _kline_json, [f.name for f in S.KLINE_SCHEMA.fields],
        CANDLE_DBL | {"TakerBuyBaseAssetVolume", "TakerBuyQuoteAssetVolume"},
        "SELECT datetime + INTERVAL 9 HOUR AS datetime, symbol, open, high, low, close, volume, "
        "QuoteAssetVolume, NumTrades, 0.0 AS TakerBuyBaseAssetVolume, 0.0 AS TakerBuyQuoteAssetVolume, "
        f"'0' AS Ignore FROM ({C1H})", "SRC1 CST1 DT1 DT2"),
    "delta_gain_loss": Query(
        _delta_gain_loss,
        ["symbol", "datetime", "close", "prev_close", "delta", "up", "down", "ups_nb", "downs_nb"],
        {"close", "prev_close", "delta", "up", "down", "ups_nb", "downs_nb"},
        "SELECT *, CASE WHEN delta < 0 THEN 0.0 ELSE delta END AS ups_nb, "
        "abs(CASE WHEN delta > 0 THEN 0.0 ELSE delta END) AS downs_nb "
        f"FROM ({Q.gains(C1H)})", "WIN1 PRJ3 PRJ4 PD1 PD2"),
    "ewma_history": Query(
        lambda s, d: _rsi_rows(s, d, "1 hour"), ["symbol", "datetime", "up_ewma", "down_ewma"],
        {"up_ewma", "down_ewma"}, Q.rsi_full(C1H), "WIN3 UDF1"),
    "ewma_close": Query(
        lambda s, d: ewma(_candles(s, d, "1 hour"), "close", S.COM, "close_ewma",
                          interval_micros("1 hour"), BLOCK),
        ["symbol", "datetime", "close_ewma"], {"close_ewma"},
        "SELECT symbol, datetime, list_reduce(list(close) OVER (PARTITION BY symbol ORDER BY datetime "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), {Q.FOLD}) AS close_ewma FROM ({C1H})",
        "WIN3 UDF1"),
    "rsi_history": Query(
        lambda s, d: _rsi_rows(s, d, "1 hour"), S.RSI_COLUMNS, RSI_DBL, Q.rsi_full(C1H),
        "CMP1 PRJ5 PRJ6 PRJ1"),
    "rsi_update_200": Query(
        lambda s, d: rsi_tail(_candles(s, d, "1 hour"), "1 hour", block_rows=BLOCK),
        S.RSI_COLUMNS, RSI_DBL, Q.rsi_tail(C1H), "WIN4 CMP2"),
    "rsi_warmup": Query(
        lambda s, d: rsi_warmup(_candles(s, d, "1 hour"), "1 hour", block_rows=BLOCK),
        ["datetime", "symbol", "close", "AU", "AD", "RSI"], {"close", "AU", "AD", "RSI"},
        None, "WIN5 CMP3 PD3"),
    "latest_rsi": Query(
        lambda s, d: topn.newest(_rsi_rows(s, d, "1 hour")), S.RSI_COLUMNS, RSI_DBL,
        f"SELECT * FROM ({Q.rsi_full(C1H)}) QUALIFY row_number() OVER "
        "(PARTITION BY symbol ORDER BY datetime DESC) = 1", "SRT2 SRT4 PRJ1"),
    "newest_n_per_symbol": Query(
        lambda s, d: topn.newest_n(_candles(s, d, "4 hours"), S.DIVERGENCE_ROWS),
        CANDLE_COLS + ["rn"], CANDLE_DBL,
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) AS rn "
        f"FROM ({C4H})) WHERE rn <= {S.DIVERGENCE_ROWS}", "SRC5 SRT3"),
    "drop_last_15": Query(
        lambda s, d: topn.drop_newest(_candles(s, d, "4 hours"), 15), CANDLE_COLS, CANDLE_DBL,
        f"SELECT * FROM ({C4H}) QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) > 15",
        "SRT5"),
    "oversold_overbought": Query(
        lambda s, d: _rsi_rows(s, d, "1 hour").where(dv.oversold() | dv.overbought())
        .withColumn("zone", F.when(dv.oversold(), "oversold").otherwise("overbought")),
        ["symbol", "datetime", "rsi", "zone"], {"rsi"},
        f"SELECT *, CASE WHEN rsi <= {S.OVERSOLD} THEN 'oversold' ELSE 'overbought' END AS zone "
        f"FROM ({Q.rsi_full(C1H)}) WHERE rsi <= {S.OVERSOLD} OR rsi >= {S.OVERBOUGHT}", "FLT1"),
    "divergence_flags": Query(
        lambda s, d: _flags(s, d), FLAG_COLS + ["bull", "bear"], FLAG_DBL,
        Q.flags(Q.rsi_full(C4H)), "CMP4 CMP5 FLT2 FLT3"),
    "bullish_divergence": Query(
        lambda s, d: _flags(s, d).where("bull"), FLAG_COLS, FLAG_DBL,
        f"SELECT * FROM ({Q.flags(Q.rsi_full(C4H))}) WHERE bull", "CMP4 FLT1 FLT2 FLT3"),
    "bearish_divergence": Query(
        lambda s, d: _flags(s, d).where("bear"), FLAG_COLS, FLAG_DBL,
        f"SELECT * FROM ({Q.flags(Q.rsi_full(C4H))}) WHERE bear", "CMP5 FLT1 FLT2 FLT3"),
    "signals": Query(
        lambda s, d: dv.signals(_flags(s, d)), ["datetime", "symbol", "close", "diversions", "convert"],
        {"close"},
        f"SELECT datetime, symbol, close, CAST(CASE WHEN bear THEN {S.BEARISH} ELSE {S.BULLISH} END AS INTEGER) "
        f"AS diversions, CAST(0 AS INTEGER) AS convert FROM ({Q.flags(Q.rsi_full(C4H))}) WHERE bull OR bear",
        "CMP6 PRJ2"),
    "conversion_check": Query(
        _conversion,
        ["symbol", "datetime", "close", "signal_datetime", "signal_close", "diversions", "pct",
         "convert", "age_days", "expired"], {"close", "signal_close", "pct"},
        "WITH life AS (" + Q.lifecycle_final(Q.flags(Q.rsi_full(C4H))) + "), "
        "now AS (SELECT symbol, datetime, close, kind, signal_datetime, signal_close FROM life "
        "WHERE datetime <= (SELECT max(datetime) FROM life WHERE kind > 0) "
        "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) = 1), "
        "j AS (SELECT symbol, datetime, close, signal_datetime, signal_close, kind AS diversions, "
        "CASE WHEN close = signal_close THEN 0.0 ELSE (signal_close - close) / nullif(close, 0) * 100 END AS pct, "
        "CAST(floor((epoch_us(datetime) - epoch_us(signal_datetime)) / 86400000000) AS INTEGER) AS age_days "
        "FROM now WHERE kind > 0) "
        f"SELECT *, CAST(CASE WHEN (pct >= {S.CONVERT_PCT} AND diversions = {S.BULLISH}) OR "
        f"(pct <= -{S.CONVERT_PCT} AND diversions = {S.BEARISH}) THEN 1 ELSE 0 END AS INTEGER) AS convert, "
        f"age_days >= {S.EXPIRY_DAYS} AS expired FROM j", "CMP7 PRJ7 DT3 FLT5"),
    "signal_lifecycle": Query(
        lambda s, d: _life(s, d), LIFE_COLS, LIFE_DBL, Q.lifecycle_final(Q.flags(Q.rsi_full(C4H))),
        "LIFE1 FLT4 FLT5"),
    "state_table": Query(
        _state, ["symbol", "state"], set(),
        f"SELECT symbol, CAST(live_after AS BIGINT) AS state FROM ({Q.lifecycle_final(Q.flags(Q.rsi_full(C4H)))}) "
        "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) = 1", "SRC6 SRC8 SNK3"),
    "backfill_rsi": Query(_backfilled, S.RSI_COLUMNS, RSI_DBL, Q.rsi_full(O1D), "PIPE2 SNK1 SRT1 SRC5"),
    "klines_table": Query(
        _klines_table, [f.name for f in S.KLINE_SCHEMA.fields],
        CANDLE_DBL | {"TakerBuyBaseAssetVolume", "TakerBuyQuoteAssetVolume"},
        "SELECT datetime, symbol, open, high, low, close, volume, QuoteAssetVolume, NumTrades, "
        "0.0 AS TakerBuyBaseAssetVolume, 0.0 AS TakerBuyQuoteAssetVolume, '0' AS Ignore "
        f"FROM ({C1H})", "SRC3 SNK1 SRT1"),
    "kline_responses": Query(
        _responses, ["symbol", "datetime", "open", "close", "NumTrades", "rejected"], {"open", "close"},
        "SELECT symbol, CASE WHEN NumTrades % 11 <> 0 THEN datetime + INTERVAL 9 HOUR END AS datetime, open, "
        "CASE WHEN NumTrades % 7 <> 0 THEN close END AS close, NumTrades, "
        f"NumTrades % 7 = 0 OR NumTrades % 11 = 0 AS rejected FROM ({C1H})", "SRC1 CST1 (landed files, dirty values)"),
    "daily_tick": Query(
        _daily_tick, ["datetime", "symbol", "close", "rsi", "bull", "bear", "kind", "signal_datetime", "signal_close",
                      "pct", "converted", "age_days", "live_after"], {"close", "rsi", "signal_close", "pct"},
        Q.daily_tick(O1D), "PIPE1 CMP2 CMP4 CMP5 CMP7 FLT4 SNK2 SNK3"),
    "daily_tick_recovery": Query(
        _tick_recovery, ["datetime", "symbol", "close", "rsi", "bull", "bear", "kind", "signal_datetime", "signal_close",
                         "pct", "converted", "age_days", "live_after"], {"close", "rsi", "signal_close", "pct"},
        Q.daily_tick(O1D), "PIPE1 SNK1 SNK2 SNK3 (a tick whose job died is taken up whole)"),
    "corrected_rsi": Query(
        lambda s, d: read_table(s, os.path.join(_corrected(s, d), "klines_rsi")), S.RSI_COLUMNS, RSI_DBL, Q.rsi_full(O1D),
        "SNK2 CMP1 (changed and late candles: RSI rows as after a backfill)"),
    "corrected_ticks": Query(
        lambda s, d: read_table(s, os.path.join(_corrected(s, d), "ticks")), LIFE_COLS, LIFE_DBL,
        Q.lifecycle_final(Q.flags(Q.rsi_full(O1D))), "SNK2 LIFE1 (changed and late candles: signals replayed)"),
    "daily_state": Query(
        _daily, LIFE_COLS, LIFE_DBL,
        f"SELECT * FROM ({Q.lifecycle_final(Q.flags(Q.rsi_full(O1D)))}) "
        "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) = 1", "LIFE1 (newest row, by replay)"),
    "signal_json": Query(
        lambda s, d: to_json_messages(dv.signals(_flags(s, d))), ["value"], set(), None, "SNK4"),
    "kafka_frame": Query(
        lambda s, d: kafka_frame(dv.signals(_flags(s, d))), ["key", "value"], set(), None, "SNK5"),
}


def _csv_warmup(spark, sf):
    """SRC7: daily candles landed as CSV (one folder per symbol), read back
    with the notebook's explicit schema, then the warm-up RSI (CMP3)."""
    from candlewick.sources.klines import read_csv_candles
    path = run_folder(spark, "csv")
    (_daily_orders(spark, sf).select("symbol", *[f.name for f in S.CSV_CANDLE_SCHEMA.fields])
     .write.partitionBy("symbol").option("header", True).csv(path))
    c = read_csv_candles(spark, path).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))
    return rsi_warmup(c, "1 day", block_rows=BLOCK, exact=True)


def _with_gaps(spark, sf):
    """Daily candles of which one in twenty lacks its close."""
    return _daily_orders(spark, sf).withColumn("close", F.when(F.dayofyear("datetime") % 20 != 3, F.col("close")))


def _csv_permuted(spark, sf):
    """SRC7 with files of two layouts, further columns, and malformed values
    (close where trades % 7 = 0, time where trades % 11 = 0)."""
    from candlewick.sources.klines import read_csv_candles
    path = run_folder(spark, "csv")
    n = F.col("NumTrades")
    text = [F.when(n % 11 == 0, F.lit("soon")).otherwise(F.col("datetime").cast("string")).alias("datetime"),
            F.when(n % 7 == 0, F.lit("n/a")).otherwise(F.col("close").cast("string")).alias("close"), "open", "low",
            n.alias("NumTrades"), "high", "volume"]
    c = _daily_orders(spark, sf)
    for i, columns in enumerate((text, [*reversed(text), F.lit("x,y").alias("note")])):
        part = c.where(F.pmod(F.ascii("symbol"), F.lit(2)) == i)
        part.select("symbol", *columns).write.mode("append").partitionBy("symbol").option("header", True).csv(path)
    return read_csv_candles(spark, path, strict=False, rejected="rejected").withColumn(
        "datetime", F.col("datetime").cast("timestamp_ntz"))


def _fed(spark, sf):
    """All ticks in three feeds, each with ticks of any time, and the second
    one sent twice; the candles of all intervals."""
    t, out = event_ticks(spark, sf), run_folder(spark, "fed")
    for i in (2, 0, 0, 1):
        feed_ticks(spark, out, t.where(F.pmod("seq", F.lit(3)) == i), f"part {i}")
    return reduce(DataFrame.unionByName, [fed_candles(spark, out, x).withColumn("span", F.lit(x)) for x in INTERVALS])


def _events_path(sf):
    return os.path.join(sf, "events.parquet")


def _stream_candles(spark, sf):
    return spark.read.parquet(landed_glob(run_candle_stream(spark, _events_path(sf), "1 day", delay=None)))


def _stream_signals(spark, sf):
    return run_streams(spark, _events_path(sf), "4 hours", delay=None)


def _closed(candles_sql, interval):
    """Windows the watermark has closed at end of input (delay 0)."""
    return (f"SELECT * FROM ({candles_sql}) WHERE datetime + INTERVAL '{interval}' <= "
            f"(SELECT date_trunc('millisecond', max(ts)) FROM ({Q.EVENT_TICKS}))")


C4H_CLOSED = _closed(C4H, "4 hours")

WARM_SQL = ("SELECT datetime, symbol, close, AU, AD, CASE WHEN AU IS NULL OR AD IS NULL THEN NULL "
            "WHEN AD = 0 THEN CASE WHEN AU > 0 THEN 100.0 END ELSE 100.0 - 100.0 / (1.0 + AU / AD) END AS RSI "
            f"FROM (SELECT *, CASE WHEN t >= {S.WARMUP_PERIODS} THEN up_ewma / (1.0 - pow({Q.KEEP}, t)) END AS AU, "
            f"CASE WHEN t >= {S.WARMUP_PERIODS} THEN down_ewma / (1.0 - pow({Q.KEEP}, t)) END AS AD "
            "FROM ({src}))")

C1M = Q.candles(Q.EVENT_TICKS, "1 minute")

QUERIES["rsi_warmup"].sql = WARM_SQL.replace("{src}", Q.rsi_full(C1H))
QUERIES["rsi_warmup_last_20"] = Query(
    lambda s, d: topn.newest_n(rsi_warmup(_candles(s, d, "1 hour"), "1 hour", block_rows=BLOCK), 20),
    ["datetime", "symbol", "close", "AU", "AD", "RSI", "rn"], {"close", "AU", "AD", "RSI"},
    "SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) AS rn FROM ("
    + WARM_SQL.replace("{src}", Q.rsi_full(C1H)) + ") QUALIFY rn <= 20",
    "SRT5 PD3 (the notebook's last-20 view)")

SIGNALS_SQL = (f"SELECT datetime, symbol, close, CAST(CASE WHEN bear THEN {S.BEARISH} ELSE {S.BULLISH} END "
               f"AS INTEGER) AS diversions, CAST(0 AS INTEGER) AS convert "
               f"FROM ({Q.flags(Q.rsi_full(C4H))}) WHERE bull OR bear")
SIGNAL_JSON_SQL = ("SELECT symbol AS key, '{\"datetime\":\"' || strftime(datetime, '%Y-%m-%dT%H:%M:%S.000') || "
                   "'\",\"symbol\":\"' || symbol || '\",\"close\":' || CAST(close AS VARCHAR) || ',\"diversions\":' "
                   "|| diversions || ',\"convert\":' || \"convert\" || '}' AS value FROM (" + SIGNALS_SQL + ")")
QUERIES["signal_json"].sql = f"SELECT value FROM ({SIGNAL_JSON_SQL})"
QUERIES["kafka_frame"].sql = SIGNAL_JSON_SQL
SIGNAL_MSG_SCHEMA = ("datetime timestamp_ntz, symbol string, close double, "
                     "diversions int, convert int")


def _signal_roundtrip(spark, sf):
    return parse_messages(to_json_messages(dv.signals(_flags(spark, sf))), SIGNAL_MSG_SCHEMA)


def _kafka_roundtrip(spark, sf):
    return parse_messages(kafka_frame(dv.signals(_flags(spark, sf))), SIGNAL_MSG_SCHEMA)


QUERIES.update({
    "signal_json_roundtrip": Query(
        _signal_roundtrip, ["datetime", "symbol", "close", "diversions", "convert"], {"close"},
        SIGNALS_SQL, "SNK4 (encode with to_json, decode, compare)"),
    "kafka_frame_roundtrip": Query(
        _kafka_roundtrip, ["key", "datetime", "symbol", "close", "diversions", "convert"], {"close"},
        f"SELECT symbol AS key, * FROM ({SIGNALS_SQL})", "SNK5 (key = symbol, value decoded)"),
    "rsi_history_1m": Query(
        lambda s, d: _rsi_rows(s, d, "1 minute"), S.RSI_COLUMNS, RSI_DBL, Q.rsi_full(C1M),
        "RES3 CMP1 WIN3 (minute candles: several blocks per symbol)"),
    "csv_rsi_warmup": Query(_csv_warmup, ["datetime", "symbol", "close", "AU", "AD", "RSI"],
                            {"close", "AU", "AD", "RSI"}, WARM_SQL.replace("{src}", Q.rsi_full(O1D)),
                            "SRC7 CMP3"),
    "candles_fed": Query(
        _fed, CANDLE_COLS + ["span"], CANDLE_DBL,
        " UNION ALL ".join(f"SELECT *, '{x}' AS span FROM ({c})" for x, c in zip(INTERVALS, (C1H, C4H, C1D))),
        "RES1 RES2 RES3 (merged from feeds in any order)"),
    "csv_permuted": Query(
        _csv_permuted, ["symbol", "datetime", "open", "high", "low", "close", "volume", "NumTrades", "rejected"],
        {"open", "high", "low", "close", "volume"},
        "SELECT symbol, CASE WHEN NumTrades % 11 <> 0 THEN datetime END AS datetime, open, high, low, "
        "CASE WHEN NumTrades % 7 <> 0 THEN close END AS close, volume, NumTrades, "
        f"NumTrades % 7 = 0 OR NumTrades % 11 = 0 AS rejected FROM ({O1D})", "SRC7 CST1 (by name, rejects marked)"),
    "rsi_warmup_gaps": Query(
        lambda s, d: rsi_warmup(_with_gaps(s, d), "1 day", block_rows=BLOCK),
        ["datetime", "symbol", "close", "AU", "AD", "RSI"], {"close", "AU", "AD", "RSI"},
        Q.warmup_gaps(f"SELECT * REPLACE (CASE WHEN dayofyear(datetime) % 20 <> 3 THEN close END AS close) FROM ({O1D})"),
        "WIN5 CMP3 PD2 (candles without a close)"),
    "stream_candles": Query(_stream_candles, CANDLE_COLS, CANDLE_DBL, _closed(C1D, "1 day"), "STR1 STR4"),
    "stream_rsi": Query(_stream_signals, S.RSI_COLUMNS, RSI_DBL, Q.rsi_full(C4H_CLOSED), "STR2 STR4"),
    "stream_lifecycle": Query(_stream_signals, LIFE_COLS, LIFE_DBL,
                              Q.lifecycle_final(Q.flags(Q.rsi_full(C4H_CLOSED))), "STR3 STR4"),
})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.spark for name, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.oracle() for name, q in QUERIES.items() if q.sql is not None}
