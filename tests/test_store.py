"""The commit log: whole commits or none, slices by the index, corrections."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from candlewick import schema as S
from candlewick.plans import jobs
from candlewick.plans.corrections import REACH
from candlewick.plans.jobs import backfill_candles, correct_candles, daily_tick, replay_state, stage_tick
from candlewick.session import materialize
from candlewick.sinks.store import Commit, Conflict, Store
from candlewick.sinks.tables import read_state, read_table
from candlewick.streaming.jobs import run_folder
from tests.conftest import SF001

TABLES = ("klines", "klines_rsi", "ticks", "state")


def series(spark, days, symbols=("A", "B+ c/%d"), start="2015-01-01"):
    """Daily candles, a price that wanders."""
    day = F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(days=F.col("id").cast("int"))
    noise = lambda salt: F.pmod(F.xxhash64("id", "symbol", F.lit(salt)), F.lit(1000)) / 1000.0
    df = spark.range(days).select(F.explode(F.array(*map(F.lit, symbols))).alias("symbol"), "id", day.alias("datetime"))
    close = 100 + 30 * F.sin(F.col("id") / 17.0) + 8 * noise(1)
    return materialize(df.select("symbol", "datetime", (close + noise(2)).alias("open"), (close + 2 * noise(3)).alias("high"),
                                 (close - 2 * noise(4)).alias("low"), close.alias("close"), F.lit(1.0).alias("volume")))


def stored(spark, out):
    return {t: sorted(map(str, (read_state if t == "state" else read_table)(spark, os.path.join(out, t)).collect()))
            for t in TABLES}


def started(spark, candles):
    out = run_folder(spark, "store")
    backfill_candles(spark, candles, out, "1 day")
    replay_state(spark, out, "1 day")
    return out


@pytest.fixture(scope="module")
def two_days(spark):
    """(candles, the next day's, tables of an undisturbed tick, a copy of the store before it)"""
    c = series(spark, 420)
    last = c.agg(F.max("datetime")).first()[0]
    old, new = c.where(F.col("datetime") < F.lit(last)), c.where(F.col("datetime") == F.lit(last))
    out = started(spark, old)

    def copy():
        return shutil.copytree(out, os.path.join(run_folder(spark, "copy"), "s"))
    ticked = copy()
    daily_tick(spark, ticked, new)
    return old, new, stored(spark, ticked), copy


def test_a_job_that_dies_leaves_the_tables_as_they_were(spark, two_days, monkeypatch):
    """At each of the four writes, and before the log file; then it runs again."""
    old, new, expected, copy = two_days
    out = copy()
    before, n = stored(spark, out), Store(spark, out).versions()
    for dies_at in range(5):
        calls = []

        def dying(real):
            def wrapped(*a, **k):
                if len(calls) == dies_at:
                    raise OSError("the job is gone")
                calls.append(a[1])
                return real(*a, **k)
            return wrapped
        with monkeypatch.context() as m:
            m.setattr(Commit, "write", dying(Commit.write))
            m.setattr(Commit, "write_whole", dying(Commit.write_whole))
            m.setattr(Store, "_publish", dying(Store._publish))
            with pytest.raises(OSError):
                daily_tick(spark, out, new)
        assert len(calls) == dies_at
        assert stored(spark, out) == before and Store(spark, out).versions() == n
    assert daily_tick(spark, out, new).count() == new.count()
    assert stored(spark, out) == expected
    assert daily_tick(spark, out, new).count() == 0 and stored(spark, out) == expected


def test_of_two_writers_one_gets_a_conflict(spark, two_days):
    old, new, expected, copy = two_days
    out = copy()
    _, slower = stage_tick(spark, out, new)
    daily_tick(spark, out, new)
    with pytest.raises(Conflict):
        slower.commit()
    assert stored(spark, out) == expected


def test_a_tick_reads_the_newest_slices_alone(spark, monkeypatch):
    """A hundred stored years: the files of the newest 200 rows, also across a gap."""
    c = series(spark, 365 * 100 + 25, ("A",), "1900-01-01")
    gap = series(spark, 30, ("B",), "1910-03-01").unionByName(series(spark, 30, ("B",), "1990-03-01"))
    out = started(spark, c.unionByName(gap))
    opened = []
    real = Store.read
    monkeypatch.setattr(Store, "read", lambda *a: opened.append((a[2], (df := real(*a)))) or df)
    day = F.expr("INTERVAL 1 DAY")
    new = c.unionByName(gap).groupBy("symbol").agg(F.max_by(F.struct(*c.columns), "datetime").alias("x")).select(
        "x.*").withColumn("datetime", F.col("datetime") + day)
    assert daily_tick(spark, out, new).count() == 2
    files = {t: {f for n, df in opened if n == t for f in df.inputFiles()} for t in ("klines", "klines_rsi", "ticks")}
    years = {t: sorted(f.split("symbol=")[1].split("/part")[0] for f in x) for t, x in files.items()}
    assert len(years["klines"]) <= 4 and {"B/year=1910", "B/year=1990"} <= set(years["klines"])
    assert len(years["klines_rsi"]) <= 4 and len(years["ticks"]) <= 2
    kept = {"A": 1, "B": 2}
    assert all(sum(y.startswith(s) for y in years["klines"]) <= n + 1 for s, n in kept.items())


def test_slices_stay_one_sorted_file(spark, two_days):
    old, new, _, copy = two_days
    out = copy()
    day = F.expr("INTERVAL 1 DAY")
    for _ in range(2):
        daily_tick(spark, out, new)
        new = new.withColumn("datetime", F.col("datetime") + day)
    store = Store(spark, out)
    snap = store.snapshot()
    sizes = store.entries(snap).where("symbol IS NOT NULL").select("table", "symbol", "slice", F.size("files").alias("n"), "rows")
    assert {r.n for r in sizes.collect()} == {1}
    assert store.read(snap, "klines").count() == sizes.where("table = 'klines'").agg(F.sum("rows")).first()[0]
    # older versions stay readable until they are swept away
    first = store.snapshot(store.versions()[0])
    assert store.read(first, "klines").count() == old.count()
    before = stored(spark, out)
    assert store.vacuum(keep=1) > 0 and stored(spark, out) == before
    assert store.versions() == [snap.version]


def test_merged_manifests(spark, two_days, monkeypatch):
    monkeypatch.setattr("candlewick.sinks.store.MERGED", 2)
    old, new, expected, copy = two_days
    out = copy()
    assert len(Store(spark, out).snapshot().manifests) == 2
    daily_tick(spark, out, new)
    assert len(Store(spark, out).snapshot().manifests) == 1
    assert stored(spark, out) == expected


def test_ticks_that_are_refused(spark, two_days):
    old, new, _, copy = two_days
    out = copy()
    before = stored(spark, out)
    last = old.where(F.col("datetime") == F.lit(old.agg(F.max("datetime")).first()[0]))
    one = F.col("symbol") == "A"
    with pytest.raises(ValueError, match="other values"):
        daily_tick(spark, out, last.withColumn("close", F.col("close") + 1))
    with pytest.raises(ValueError, match="two versions"):
        daily_tick(spark, out, new.unionByName(new.where(one).withColumn("close", F.col("close") + 1)))
    with pytest.raises(ValueError, match="older"):
        daily_tick(spark, out, last.withColumn("datetime", F.col("datetime") - F.expr("INTERVAL 1 HOUR")))
    for c in ("symbol", "datetime"):
        with pytest.raises(Exception, match=f"no {c}"):
            daily_tick(spark, out, new.withColumn(c, F.when(~one, F.col(c))))
    with pytest.raises(ValueError, match="newer"):
        correct_candles(spark, out, new)
    with pytest.raises(ValueError, match="no state"):
        daily_tick(spark, run_folder(spark, "none"), new)
    # as stored, and twice the same: nothing to do
    assert daily_tick(spark, out, last.unionByName(last)).count() == 0
    assert stored(spark, out) == before


def test_a_new_symbol_and_fewer_columns(spark, two_days):
    old, new, _, copy = two_days
    out = copy()
    newcomer = new.where("symbol = 'A'").withColumn("symbol", F.lit("C")).drop("volume")
    got = daily_tick(spark, out, newcomer.withColumn("extra", F.lit(1))).collect()
    assert [(r.symbol, r.rsi, r.kind) for r in got] == [("C", None, 0)]
    assert read_table(spark, os.path.join(out, "klines")).where("symbol = 'C' AND volume IS NULL").count() == 1


def corrected_equal_backfill(spark, wrong, true, later=None):
    out, clean = started(spark, wrong), started(spark, true)
    n = correct_candles(spark, out, true if later is None else later)
    a, b = stored(spark, out), stored(spark, clean)
    for t in TABLES:
        assert a[t] == b[t], t
    return out, n


def test_corrections_equal_a_backfill(spark):
    """Bits and all: changed, late and repeated candles, across slices."""
    c = series(spark, 2200)
    draw = F.pmod(F.xxhash64("symbol", "datetime"), F.lit(100))
    last = c.agg(F.max("datetime")).first()[0]
    some = F.col("datetime") < F.lit(last)
    wrong = c.where((draw != 7) | ~some).withColumn("close", F.when((draw == 3) & some, F.col("close") * 1.3).otherwise(F.col("close")))
    _, n = corrected_equal_backfill(spark, wrong, c)
    assert n == c.where(draw.isin(3, 7) & some).count() > 50


def test_a_correction_reaches_no_further_than_it_has_to(spark):
    """One old candle: RSI slices within the reach, all later signals, no other symbol."""
    c = series(spark, 3650)
    day = c.where("symbol = 'A'").agg(F.min("datetime")).first()[0]
    at = (F.col("symbol") == "A") & (F.col("datetime") == F.lit(day) + F.expr("INTERVAL 1000 DAYS"))
    wrong = c.withColumn("low", F.when(at, F.col("low") - 50).otherwise(F.col("low"))).withColumn(
        "close", F.when(at, F.col("close") - 20).otherwise(F.col("close")))
    out, n = corrected_equal_backfill(spark, wrong, c, c.where(at))
    assert n == 1
    store = Store(spark, out)
    snap = store.snapshot()
    new = store.entries(snap).where(F.col("seq") == snap.version).groupBy("table").agg(
        F.collect_set("symbol").alias("symbols"), F.count(F.lit(1)).alias("n")).collect()
    got = {r.table: (r.symbols, r.n) for r in new}
    assert got["klines"] == (["A"], 1)
    assert got["klines_rsi"][0] == ["A"] and got["klines_rsi"][1] <= 2 + REACH // 365
    assert got["ticks"][0] == ["A"] and got["ticks"][1] <= 8
    assert correct_candles(spark, out, c.where(at)) == 0


def test_correction_of_a_first_row_and_a_new_one_before_it(spark):
    c = series(spark, 900, ("A",)).unionByName(series(spark, 900, ("B",)).where("datetime > '2015-01-01'"))
    wrong = c.where("symbol = 'A' AND datetime > '2015-01-01' OR symbol = 'B'").withColumn(
        "close", F.when(F.col("datetime") == F.lit("2015-01-02"), F.lit(5.0)).otherwise(F.col("close")))
    corrected_equal_backfill(spark, wrong, c)


def test_null_symbols_fail_and_do_not_vanish(spark):
    from candlewick.operators.rsi import rsi
    c = series(spark, 45, ("A",))
    bad = c.unionByName(c.limit(20).withColumn("symbol", F.lit(None).cast("string")))
    with pytest.raises(Exception, match="no symbol"):
        rsi(bad, "1 day").count()
    assert jobs.S.RSI_COLUMNS == S.RSI_COLUMNS and rsi(c, "1 day").count() == 45


def test_feeds_in_any_order_equal_one_batch(spark):
    """Late ticks touch their own buckets' slices; a feed counts once; one that died can be fed again."""
    from candlewick.operators.resample import candles_from_ticks
    from candlewick.plans.feeds import INTERVALS, fed_candles, feed_ticks, table_of
    from candlewick.sources.ticks import event_ticks
    ticks, out = materialize(event_ticks(spark, SF001)), run_folder(spark, "fed")
    late = F.dayofmonth("ts") <= 3
    parts = [ticks.where(~late & (F.pmod("seq", F.lit(2)) == i)) for i in (0, 1)] + [ticks.where(late)]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(Store, "_publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            feed_ticks(spark, out, parts[0], "a")
    assert [feed_ticks(spark, out, p, n) for p, n in zip([*parts, parts[0]], "abca")] == [True, True, True, False]
    for x in INTERVALS:
        whole = candles_from_ticks(ticks, x)
        a, b = (sorted(map(str, df.select([F.round(c, 6).alias(c) if k == "double" else c for c, k in whole.dtypes]).collect()))
                for df in (whole, fed_candles(spark, out, x)))
        assert a == b and len(a) > 5
    store = Store(spark, out)
    new = store.entries(store.snapshot(), table_of("1 hour"))
    assert new.where(F.col("seq") == 3).count() == parts[2].select("symbol", F.date_format("ts", "yyyy-MM")).distinct().count()
