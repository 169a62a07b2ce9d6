"""Physical-plan shape: the scale properties the operators are built for."""

import re

from candlewick.operators import lifecycle as lc
from candlewick.operators.divergence import divergence_flags
from candlewick.operators.resample import candles_from_ticks
from candlewick.operators.rsi import rsi_frame
from candlewick.operators.sequence import with_row_index
from candlewick.operators.topn import newest_n
from candlewick.sources.ticks import event_ticks
from tests.conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_candles_hash_aggregate_pushdown_pruning(spark):
    plan = _plan(candles_from_ticks(event_ticks(spark, SF001), "1 hour"))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "IsNotNull(ts)" in plan and "IsNotNull(value)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "user_id" not in schema and "props" not in schema


def test_newest_n_limits_map_side(spark):
    c = candles_from_ticks(event_ticks(spark, SF001), "1 hour")
    assert "WindowGroupLimit" in _plan(newest_n(c, 30))


def test_rsi_after_materialization_moves_no_rows(spark):
    """The bucketed block table feeds the carry join and the exact-fold
    cogroup in place: no shuffle above it carries whole candle rows."""
    c = candles_from_ticks(event_ticks(spark, SF001), "4 hours")
    lines = _plan(rsi_frame(c, "4 hours", block_rows=64)).splitlines()
    assert any("FileScan parquet spark_catalog" in ln for ln in lines)
    for i, ln in enumerate(lines):
        if "Exchange hashpartitioning" in ln:
            assert "datetime" not in lines[i + 1] and "close" not in lines[i + 1], lines[i + 1]


def test_lifecycle_python_groups_are_blocks(spark):
    c = candles_from_ticks(event_ticks(spark, SF001), "4 hours")
    f = divergence_flags(rsi_frame(c, "4 hours", block_rows=64), 64)
    plan = _plan(lc.lifecycle(f, block_rows=64))
    groups = re.findall(r"FlatMapCoGroupsInPandas \[([^\]]*)\]", plan)
    assert groups and all("_lb" in g or "_blk" in g for g in groups)
    assert "FlatMapGroupsInPandas" not in plan


def test_bucketed_materialization_is_read_in_place(spark):
    from pyspark.sql import functions as F
    from candlewick.session import materialize_by
    c = candles_from_ticks(event_ticks(spark, SF001), "1 hour").withColumn("_blk", F.lit(0).cast("long"))
    m = materialize_by(c.repartition("symbol", "_blk"), ["symbol", "_blk"], ["symbol", "_blk", "datetime"])
    assert "Exchange" not in _plan(m.groupBy("symbol", "_blk").count())
    assert m.count() == c.count()


def test_divergence_on_bucketed_rsi_moves_no_rows(spark):
    from candlewick.session import materialize_by
    c = candles_from_ticks(event_ticks(spark, SF001), "4 hours")
    r = materialize_by(rsi_frame(c, "4 hours", block_rows=64), ["symbol", "_blk"], ["symbol", "_blk", "_t"])
    lines = _plan(divergence_flags(r, 64)).splitlines()
    for i, ln in enumerate(lines):
        if "Exchange hashpartitioning" in ln:
            assert "datetime" not in lines[i + 1], lines[i + 1]


def test_one_scan_of_the_ticks(spark):
    """The tick table is read by the job that writes the candles by span, and
    never again: the frame's plan reads written tables only, the span counts
    once, and a query touches the source in a single scan."""
    c = candles_from_ticks(event_ticks(spark, SF001), "1 hour")
    plan = _plan(with_row_index(c, 3_600_000_000 * 64))
    assert "events.parquet" not in plan
    assert plan.count("Scan parquet spark_catalog") == 1   # the candles, in place
    assert plan.count("Scan ExistingRDD") == 1             # the counts
    assert "events.parquet" not in _plan(rsi_frame(c, "1 hour", block_rows=64))


def test_no_checkpoint_folder_on_a_cluster_is_an_error(monkeypatch):
    import pytest

    from candlewick.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_scratch_tables_are_dropped(spark):
    import os

    from candlewick.session import SCRATCH, drop_scratch, materialize_by, scratch_table_path
    m = materialize_by(spark.range(10).repartition("id"), ["id"])
    name = [t.name for t in spark.catalog.listTables() if t.name.startswith(SCRATCH)][-1]
    assert m.count() == 10 and os.path.isdir(scratch_table_path(spark, name))
    assert drop_scratch(spark) > 0 and not os.path.exists(scratch_table_path(spark, name))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(SCRATCH)]


def test_scratch_scope_drops_what_was_made_inside(spark):
    from candlewick.plans.catalogue import QUERIES
    from candlewick.session import SCRATCH, scratch_scope
    names = lambda: {t.name for t in spark.catalog.listTables() if t.name.startswith(SCRATCH)}
    QUERIES["rsi_history"].spark(spark, SF001)
    before = names()
    with scratch_scope(spark):
        df = QUERIES["rsi_history"].spark(spark, SF001)
        assert df.count() > 0 and names() > before
    assert names() == before
