import math
import random

import pytest
from pyspark.sql import functions as F

from candlewick.llm.hard_negatives import KEY, mine, packed_key, stream_windows, unpacked

SCHEMA = "vec_id long, embedding array<double>, label int, part int, anchor int, rank int"


def brute(data, every, n_pos=5, n_neg=10, low=30, high=90, scale=256):
    """All pairs; repeated whole rows count once."""
    kept = {(i, lab, tuple(math.floor(scale * x) for x in v)) for i, v, lab, *_ in data
            if None not in (i, v, lab) and not any(x is None or not math.isfinite(x) for x in v)}
    out = []
    for a, a_lab, av in kept:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(av, v)), i, lab != a_lab) for i, lab, v in kept if i != a)
        for s, p, other in [x for x in scored if not x[2]][:n_pos]:
            found = [x for x in scored if x[2] and low * -s <= 100 * -x[0] <= high * -s][:n_neg]
            out += [(a, p, r, x[1], -s, -x[0]) for r, x in enumerate(found, 1)]
    return sorted(out)


def vectors(n, dims=6, labels=3, spread=1.0, seed=1):
    r = random.Random(seed)
    return [(i, [round(r.gauss(0.4, spread), 2) for _ in range(dims)], r.randrange(labels), 7, 8, 9) for i in range(n)]


def run(spark, data, every=10, **more):
    df = spark.createDataFrame(data, SCHEMA)
    return sorted(tuple(r) for r in mine(df, F.col("vec_id") % every == 0, **more).collect())


@pytest.mark.parametrize("rows,anchors", [(16_384, 4_096), (60, 7), (11, 3)])
def test_matches_brute_force(spark, rows, anchors):
    data = vectors(400)
    got = run(spark, data, rows=rows, anchors=anchors)
    assert got == brute(data, 10) and len(got) > 500


def test_ties_and_copies(spark):
    # one vector that a third of the rows share, few different scores, whole rows that repeat
    data = [(i, [1.0, 0.5] if i % 3 == 0 else [float(i % 4), float(i % 5)], i % 2, 1, 1, 1) for i in range(300)]
    data += data[:40] + data[:1] * 150
    assert run(spark, data, rows=32, anchors=5) == brute(data, 10)


def test_zero_and_negative_positives(spark):
    # windows of a zero score hold zero scores alone, also those of smaller ids
    data = [(0, [1.0, 0.0], 0, 1, 1, 1), (1, [0.0, 2.0], 1, 1, 1, 1), (2, [0.0, 3.0], 0, 1, 1, 1),
            (3, [0.0, 1.0], 1, 1, 1, 1), (4, [-1.0, 0.0], 0, 1, 1, 1), (5, [-0.5, 0.0], 1, 1, 1, 1)]
    got = run(spark, data)
    assert got == brute(data, 10) == [(0, 2, 1, 1, 0, 0), (0, 2, 2, 3, 0, 0)]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    data = vectors(60) + [(None, [1.0] * 6, 0, 1, 1, 1), (70, None, 0, 1, 1, 1), (80, [1.0, None], 0, 1, 1, 1),
                          (90, [nan] * 6, 0, 1, 1, 1), (100, [inf], 0, 1, 1, 1), (110, [1.0] * 6, None, 1, 1, 1),
                          (120, [], 0, 1, 1, 1), (130, [2.0, 2.0], 1, 1, 1, 1), (140, [1.0] * 6, 99, 1, 1, 1),
                          # one id, two vectors: an anchor each, and rows of their own
                          (150, [1.0] * 6, 1, 1, 1, 1), (150, [0.5] * 6, 1, 1, 1, 1), (-10, [0.9] * 6, 1, 1, 1, 1)]
    assert run(spark, data, rows=16) == brute(data, 10)
    assert run(spark, data[:1]) == []
    assert mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0).collect() == []


def test_large_scores(spark):
    data = [(i, [v * 1e6 for v in x], lab, *r) for i, x, lab, *r in vectors(80)]
    assert run(spark, data) == brute(data, 10)
    data = [(i, [v * 1e12 for v in x], lab, *r) for i, x, lab, *r in vectors(80)]
    with pytest.raises(Exception, match="62 bits"):
        run(spark, data)


def test_packed_keys_sort_as_wanted(spark):
    r = random.Random(2)
    wide = lambda: r.choice([0, -1, 1, r.randrange(-1 << 62, 1 << 62), r.randrange(-99, 99)])
    data = [(r.randrange(3), r.randrange(3), r.choice([-5, 0, 7]), wide(), wide(), i) for i in range(500)]
    df = spark.createDataFrame(data, "part int, anchor int, anchor_id long, score long, id long, row long")
    both = df.select("*", packed_key(False).alias("key"), F.lit(False).alias("neg")).unionByName(
        df.select("*", packed_key(True).alias("key"), F.lit(True).alias("neg")))
    got = both.orderBy("key").collect()
    wanted = sorted(got, key=lambda x: (x.anchor_id, x.part, x.anchor, -x.score, x.neg, x.id, x.row))
    assert got == wanted
    for x in got:
        assert unpacked(bytes(x.key)) == ((x.anchor_id + (1 << 63), x.part, x.anchor), x.anchor_id, x.score, x.neg, x.id)
    assert KEY == ">QIIQBQQ"


def test_stream_holds_one_anchor():
    """The iterator is lazy: results of an anchor come before the next one is read."""
    seen = []

    def keys():
        for a in range(3):
            for k in ((a, a, 100, 0, 1), (a, a, 80, 1, 2), (a, a, 40, 1, 3), (a, a, 20, 1, 4)):
                seen.append(k)
                yield k
    got = stream_windows(keys(), 10, 30, 90)
    assert next(got) == (0, 1, 1, 2, 100, 80) and len(seen) == 2
    assert list(got)[0] == (0, 1, 2, 3, 100, 40)


def test_bad_window(spark):
    with pytest.raises(ValueError):
        run(spark, vectors(20), low=90, high=30)
