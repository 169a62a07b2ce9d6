import numpy as np
import pytest

from candlewick.llm.queries import op3_topk
from candlewick.llm.topk import build_index, signed_digits, top_k
from tests.conftest import SF001


def brute(rows, k, every=50):
    """rows: (id, vector); exact scores, ties to the smaller id."""
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, q in ok:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i)[:k]
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(best)}
    return out


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert {tuple(r) for r in op3_topk(spark, SF001).collect()} == brute(rows, 5)


@pytest.mark.parametrize("block", [16, 64, 100_000])
def test_blocks_ties_and_edges(spark, block):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 6) / 256]) for i in range(150)]  # many equal scores
    rows += [(200, None), (250, [0.5, None, 0.1, 0.0, 0.0, 0.0]), (300, [float("nan")] * 6), (301, [float("inf")] * 6),
             (None, [0.1] * 6), (350, [0.25, -0.5]), (400, []), (450, [300.0, -1e6, 0.0, 2.5, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS block", "'x' AS part", "2 AS v")
    asked = df.where("vec_id % 50 = 0")
    got = top_k(build_index(df, "vec_id", "embedding", rows=block), asked.union(asked), "vec_id", "embedding", 7)
    exp = brute(rows, 7)
    assert {tuple(r) for r in got.collect()} == exp and got.count() == len(exp)


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [0.5]), (1, [1.0]), (1, [1.0])], schema)
    got = top_k(build_index(df, "vec_id", "embedding"), df.where("vec_id = 0"), "vec_id", "embedding", 5)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 1, 128 * 256), (0, 2, 1, 128 * 256)]
    none = spark.createDataFrame([], schema)
    assert top_k(build_index(none, "vec_id", "embedding"), none, "vec_id", "embedding", 5).count() == 0
    assert top_k(build_index(none, "vec_id", "embedding"), df, "vec_id", "embedding", 5).count() == 0


def test_signed_digits():
    for x in [*range(-70, 70), 10**6, -10**6 - 1]:
        digits = signed_digits([x])
        assert sum(s << i for i, s, dims in digits for _ in dims) == x
        places = sorted(i for i, _, _ in digits)
        assert all(b - a > 1 for a, b in zip(places, places[1:]))


def test_an_id_with_two_vectors_has_two_rankings(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (1, [2.0, 0.5]), (2, [0.5, 2.0]), (3, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, top_k(build_index(df, "vec_id", "embedding"), df.where("vec_id = 50"), "vec_id", "embedding", 2).collect()))
    assert got == [(50, 1, 1, 256 * 512), (50, 1, 2, 256 * 512), (50, 2, 1, 256 * 128), (50, 2, 2, 256 * 128)]
