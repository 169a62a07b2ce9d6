"""Headline benchmark: prints one JSON line with per-query seconds.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is fully executed (a no-op write of every row), so timings cover
the whole plan, not a sample.  One untimed warm-up (a small aggregation and a
pandas UDF over ``events`` on every worker slot) starts the JVM JIT and the Python workers first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from candlewick.session import get_spark  # noqa: E402
from candlewick.plans.catalogue import QUERIES  # noqa: E402

HEADLINE = ["candles_1h", "candles_4h", "resample_1h_to_4h", "kline_dedupe_latest",
            "kline_json_decode", "rsi_history", "rsi_history_1m", "rsi_update_200", "rsi_warmup",
            "divergence_flags", "signal_lifecycle", "conversion_check",
            "backfill_rsi", "daily_state"]


def _warm_up(spark, sf_dir):
    import pandas as pd
    from pyspark.sql import functions as F
    ev = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    ev.groupBy("event_type").agg(F.max("value")).write.format("noop").mode("overwrite").save()
    # 64 groups over all shuffle partitions: every Python worker slot starts once
    (ev.select((F.col("event_id") % 64).alias("g"), "value").groupBy("g")
       .applyInPandas(lambda p: pd.DataFrame({"n": [len(p)]}), "n long")
       .write.format("noop").mode("overwrite").save())


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", cpus * 2, app="candlewick-bench",
                      extra={"spark.driver.memory": "16g"})
    _warm_up(spark, sf_dir)
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name].spark(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None}))


if __name__ == "__main__":
    main()
