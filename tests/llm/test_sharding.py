import collections
import math
import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from candlewick.llm.queries import op10_sharding
from candlewick.llm.sharding import Leaf, default_tree, place, shard_documents, slots
from tests.conftest import SF001
from tests.llm.helpers import TEXTS, edge_docs, empty_docs


def brute_place(key, tree):
    """Descend by the same draws: XXH64 of key, level and child, chained as Spark chains columns."""
    def draw(level, child, weight):
        h = xxhash.xxh64_intdigest(struct.pack("<q", key), 42) if key is not None else 42
        h = xxhash.xxh64_intdigest(level.encode(), h)
        h = xxhash.xxh64_intdigest(struct.pack("<i", child), h)
        return -math.log(((h >> 11) + 0.5) / (1 << 53)) / weight

    parent, above = 0, None
    for level in ("region", "rack", "shard"):
        kids = collections.Counter()
        for leaf in tree:
            if above is None or getattr(leaf, above) == parent:
                kids[getattr(leaf, level)] += leaf.weight
        parent, above = min((draw(level, c, w), c) for c, w in kids.items() if w > 0)[1], level
    return parent


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    got = {r.doc_id: r for r in op10_sharding(spark, SF001).collect()}
    assert len(got) == len(docs)
    for d in docs:
        raw = (d.text or "").encode()
        g = got[d.doc_id]
        assert (g.size, g.text_crc32, g.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert g.shard == brute_place(d.doc_id, default_tree(40)) and g.grown_shard == brute_place(d.doc_id, default_tree(41))
        assert g.grown_shard in (g.shard, 40)
    check_slots((r.shard, r.slot) for r in got.values())


def check_slots(pairs):
    by = collections.defaultdict(list)
    for shard, slot in pairs:
        by[shard].append(slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_law_shares_and_confined_movement(spark):
    keys = spark.range(40_000)
    tree = [Leaf(r, r * 2 + k, (r * 2 + k) * 3 + s, 1.0 + r) for r in range(2) for k in range(2) for s in range(3)]
    heavier = [Leaf(x.region, x.rack, x.shard, x.weight + 2.0 * (x.shard == 7)) for x in tree]
    gone = [Leaf(x.region, x.rack, x.shard, 0.0 if x.shard == 4 else x.weight) for x in tree]
    df = place(place(place(keys, F.col("id"), tree, "a"), F.col("id"), heavier, "b"), F.col("id"), gone, "c")
    rows = df.collect()
    share = collections.Counter(r.a for r in rows)
    total = sum(x.weight for x in tree)
    for x in tree:
        assert share[x.shard] / len(rows) == pytest.approx(x.weight / total, rel=0.1)
    rack = {x.shard: x.rack for x in tree}
    moved = [(r.a, r.b) for r in rows if r.a != r.b]
    # inside the rack of shard 7 rows move to shard 7 alone; no row moves between two shards of an unchanged rack
    assert moved and all(b == 7 for a, b in moved if rack[a] == rack[b])
    assert all(rack[a] != rack[b] or rack[b] == rack[7] for a, b in moved)
    assert all(r.c != 4 for r in rows)


@pytest.mark.parametrize("bucket", [1, 3, 1000])
def test_slots_in_buckets(spark, bucket):
    df = spark.range(500).select(F.pmod("id", F.lit(4)).alias("shard"), F.pmod("id", F.lit(37)).alias("k"))
    got = slots(df, "shard", ["k"], 4, rows_per_bucket=bucket).collect()
    assert len(got) == 500
    check_slots((r.shard, r.slot) for r in got)


def test_edges(spark):
    got = shard_documents(edge_docs(spark), 40).collect()
    assert len(got) == len(TEXTS)
    check_slots((r.shard, r.slot) for r in got)
    assert len({r.shard for r in got if r.doc_id is None}) == 1 and len({r.shard for r in got if r.doc_id == 1}) == 1
    assert {(r.size, r.text_crc32) for r in got if r.doc_id in (2, 3)} == {(16, 0)}
    assert shard_documents(empty_docs(spark), 40).count() == 0


def test_no_python_in_the_plan(spark):
    plan = shard_documents(edge_docs(spark), 40)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("n,first", [(40, 40), (41, 40), (45, 40), (59, 40), (60, 40), (3, 3), (7, 3), (1, 1), (21, 20)])
def test_one_more_shard_takes_rows_only_into_itself(spark, n, first):
    rows = place(place(spark.range(20_000), F.col("id"), default_tree(n, first), "a"), F.col("id"),
                 default_tree(n + 1, first), "b").groupBy("a", "b").count().collect()
    moved = sum(r["count"] for r in rows if r.a != r.b)
    assert all(r.b == n for r in rows if r.a != r.b)
    assert abs(moved / 20_000 - 1 / (n + 1)) < 0.25 / (n + 1) + 0.003
    assert {r.b for r in rows} == set(range(n + 1))


def test_fewer_shards_than_the_first_are_refused(spark):
    with pytest.raises(ValueError, match="confined"):
        shard_documents(edge_docs(spark), 39)
    assert shard_documents(edge_docs(spark), 5, first=5).count() == len(TEXTS)
