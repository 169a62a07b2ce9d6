"""Exchange kline payloads, CSV candles and typed kline files (SRC1, SRC3, SRC7, CST1, DT1, DT2).

An exchange answers a kline request with a JSON array of arrays:
``[open_ms, "open", "high", "low", "close", "volume", close_ms, "quote_volume",
trades, "taker_base", "taker_quote", "ignore"]``.  Landed responses are
decoded on the executors with ``from_json`` + ``explode``; nothing passes
through the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick import schema as S
from candlewick.functions.indicators import interval_micros
from candlewick.functions.timefn import epoch_ms_to_ts, micros, utc_to_wall_clock

PAYLOAD_ELEMENT = "array<string>"
PAYLOAD_TYPE = f"array<{PAYLOAD_ELEMENT}>"


def pack_kline_payload(candles: DataFrame, interval: str, per: str = "1 day") -> DataFrame:
    """Candles -> one exchange-style JSON response per (symbol, ``per`` window).

    Numbers at positions 0, 6 and 8 are JSON numbers, the rest JSON strings,
    as the exchange sends them.  Taker volumes and ``ignore`` are "0".
    """
    step_ms = interval_micros(interval) // 1000
    open_ms = (micros("datetime") / 1000).cast("bigint")
    num = lambda c: F.col(c).cast("string")
    elem = F.format_string('[%d,"%s","%s","%s","%s","%s",%d,"%s",%d,"0","0","0"]',
                           open_ms, num("open"), num("high"), num("low"), num("close"),
                           num("volume"), open_ms + F.lit(step_ms - 1), num("QuoteAssetVolume"),
                           F.col("NumTrades"))
    rows = candles.select("symbol", F.window("datetime", per).start.alias("_page"),
                          F.struct(open_ms.alias("ms"), elem.alias("e")).alias("_k"))
    return (rows.groupBy("symbol", "_page")
                .agg(F.concat(F.lit("["),
                              F.array_join(F.transform(F.array_sort(F.collect_list("_k")),
                                                       lambda k: k["e"]), ","),
                              F.lit("]")).alias("payload"))
                .select("symbol", "payload"))


#: Positions of the numbers in a response's element, with their types.
_NUMBERS = {0: "bigint", 1: "double", 2: "double", 3: "double", 4: "double", 5: "double", 7: "double", 8: "int",
            9: "double", 10: "double"}


def _elements(payloads: DataFrame, symbol: str, payload: str) -> DataFrame:
    return payloads.select(F.col(symbol).alias("symbol"),
                           F.explode_outer(F.from_json(F.col(payload), PAYLOAD_TYPE)).alias("k"))


def _dirty():
    """Whether an element (or a whole response) does not decode: a number is missing or malformed."""
    bad = F.col("k").isNull()
    for i, kind in _NUMBERS.items():
        bad = bad | F.get(F.col("k"), F.lit(i)).try_cast(kind).isNull()
    return bad


def decode_kline_payload(payloads: DataFrame, tz: str | None = S.EXCHANGE_TZ,
                         symbol: str = "symbol", payload: str = "payload", strict: bool = True,
                         rejected: str | None = None) -> DataFrame:
    """SRC1: JSON responses -> 12-column ``kline`` rows (index 6 skipped).

    ``datetime`` is the candle open time as wall clock of ``tz`` (DT1 + DT2).
    A value that is no number fails the job (``strict``), as it did the
    original; ``kline_rejects`` shows such elements.  With ``strict`` off they
    are decoded with NULL for what is malformed, and ``rejected`` names a
    boolean column that marks them; nothing vanishes.
    """
    k = _elements(payloads, symbol, payload).withColumn("_bad", _dirty())
    if strict:
        told = F.concat(F.lit("a kline does not decode: "), F.coalesce(F.to_json("k"), F.lit("no JSON array")))
        k = k.withColumn("k", F.when(~F.col("_bad"), F.col("k")).otherwise(F.raise_error(told).cast(PAYLOAD_ELEMENT)))
    at = lambda i: F.get(F.col("k"), F.lit(i))
    num = lambda i: at(i).try_cast(_NUMBERS[i])
    ts = epoch_ms_to_ts(num(0))
    if tz:
        ts = utc_to_wall_clock(ts, tz)
    out = k.select(ts.alias("datetime"), "symbol",
                   num(1).alias("open"), num(2).alias("high"), num(3).alias("low"),
                   num(4).alias("close"), num(5).alias("volume"), num(7).alias("QuoteAssetVolume"),
                   num(8).alias("NumTrades"),
                   num(9).alias("TakerBuyBaseAssetVolume"), num(10).alias("TakerBuyQuoteAssetVolume"),
                   at(11).alias("Ignore"), F.col("_bad"))
    return out.withColumnRenamed("_bad", rejected) if rejected else out.drop("_bad")


def kline_rejects(payloads: DataFrame, symbol: str = "symbol", payload: str = "payload") -> DataFrame:
    """(symbol, element): what does not decode, as JSON (null: the whole response)."""
    return _elements(payloads, symbol, payload).where(_dirty()).select("symbol", F.to_json("k").alias("element"))


def read_kline_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses: JSON-lines files ``{"symbol": ..., "payload": [[...], ...]}``."""
    df = spark.read.text(path)
    return df.select(F.get_json_object("value", "$.symbol").alias("symbol"),
                     F.get_json_object("value", "$.payload").alias("payload"))


def _csv_layouts(spark: SparkSession, path: str) -> dict[tuple, list[str]]:
    """Header -> files that have it.  One pass over the lines, one row per file."""
    columns = F.transform(F.split(F.regexp_replace("value", "^\ufeff", ""), ","), lambda c: F.trim(F.regexp_replace(c, '"', "")))
    header = F.array_contains(columns, "datetime") & F.array_contains(columns, "close")
    found = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.max(F.when(header, columns)).alias("names")).collect()
    wanted = [f.name for f in S.CSV_CANDLE_SCHEMA.fields]
    layouts: dict[tuple, list[str]] = {}
    for r in found:
        lacking = sorted(set(wanted) - set(r.names or ()))
        if lacking or len(set(r.names)) < len(r.names):
            raise ValueError(f"{r.file}: the header lacks {lacking}" if lacking else f"{r.file}: a column name comes twice")
        layouts.setdefault(tuple(r.names), []).append(r.file)
    return layouts


def read_csv_candles(spark: SparkSession, path: str, symbol: str | None = None, strict: bool = True,
                     rejected: str | None = None) -> DataFrame:
    """SRC7: header CSV with the notebook's candle columns, typed.

    Columns are found by their names in each file's own header, in any order;
    other columns are left out.  An empty value is NULL.  A row is malformed if
    it has no time, a value that is no number, or more or fewer values than the
    header: it fails the job (``strict``); with ``strict`` off what is malformed
    is NULL, and ``rejected`` names a boolean column that marks such rows.
    """
    layouts, parts = _csv_layouts(spark, path), []
    for names, files in layouts.items():
        raw = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))]
                           + [T.StructField("_row", T.StringType())])
        df = (spark.read.schema(raw).option("header", True).option("columnNameOfCorruptRecord", "_row")
              .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path))
        if len(layouts) > 1:  # prunes files
            df = df.where(F.col("_metadata.file_path").isin(files))
        at = {n: F.when(F.col(f"_{i}") != "", F.col(f"_{i}")) for i, n in enumerate(names)}
        typed = {f.name: at[f.name].try_cast(f.dataType) for f in S.CSV_CANDLE_SCHEMA.fields}
        bad = F.col("_row").isNotNull() | typed["datetime"].isNull()
        for n, value in typed.items():
            bad = bad | (at[n].isNotNull() & value.isNull())
        folders = [c for c in df.columns if c not in raw.fieldNames()]  # partition columns
        parts.append(df.select(*[v.alias(n) for n, v in typed.items()], *folders, bad.alias("_bad"),
                               F.concat_ws(",", *[F.col(f"_{i}") for i in range(len(names))]).alias("_text")))
    if not parts:
        parts = [spark.createDataFrame([], S.CSV_CANDLE_SCHEMA).select("*", F.lit(False).alias("_bad"), F.lit("").alias("_text"))]
    df = reduce(DataFrame.unionByName, parts)
    if strict:
        told = F.raise_error(F.concat(F.lit("a candle row does not parse: "), F.col("_text"))).cast("timestamp")
        df = df.withColumn("datetime", F.when(F.col("_bad"), told).otherwise(F.col("datetime")))
    df = df.withColumnRenamed("_bad", rejected).drop("_text") if rejected else df.drop("_bad", "_text")
    return df.withColumn("symbol", F.lit(symbol)) if symbol is not None else df


def read_klines(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC3/SRC4: typed kline table from files (schema fixed, no inference)."""
    return spark.read.schema(S.KLINE_SCHEMA).format(fmt).load(path)
