
import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from candlewick.operators.rsi import rsi

prices = st.lists(st.floats(min_value=0.5, max_value=1e4, allow_nan=False), min_size=2, max_size=60)


def _frame(spark, closes_by_symbol):
    base = dt.datetime(2024, 1, 1)
    rows = [(s, base + dt.timedelta(hours=i), c, c, c, c)
            for s, closes in closes_by_symbol.items() for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, datetime timestamp_ntz, open double, high double, "
                                       "low double, close double")


@settings(max_examples=8, deadline=None)
@given(a=prices, b=prices, k=st.floats(min_value=0.1, max_value=100))
def test_rsi_bounds_scaling_and_independence(spark, a, b, k):
    both = rsi(_frame(spark, {"A": a, "B": b}), block_rows=8).toPandas()
    alone = rsi(_frame(spark, {"A": a}), block_rows=8).toPandas()
    scaled = rsi(_frame(spark, {"A": [x * k for x in a]}), block_rows=8).toPandas()
    r = both["rsi"].dropna()
    assert ((r >= -1e-9) & (r <= 100 + 1e-9)).all()
    ma = both[both.symbol == "A"].sort_values("datetime")["rsi"].tolist()
    mb = alone.sort_values("datetime")["rsi"].tolist()
    ms = scaled.sort_values("datetime")["rsi"].tolist()
    for x, y, z in zip(ma, mb, ms):
        assert (x is None or x != x) == (y is None or y != y)
        if x == x and x is not None:
            assert abs(x - y) < 1e-9
            if z == z and z is not None:
                assert abs(x - z) < 1e-6


def test_monotone_rise_has_null_rsi(spark):
    out = rsi(_frame(spark, {"A": [float(i) for i in range(1, 40)]}), block_rows=8).toPandas()
    assert out["rsi"].isna().all()


def test_flat_prices(spark):
    out = rsi(_frame(spark, {"A": [5.0] * 20}), block_rows=8).toPandas()
    assert (out["up_ewma"] == 0).all() and out["rsi"].isna().all()
