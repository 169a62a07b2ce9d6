"""candlewick: OHLCV candle analytics (RSI, divergence, signal lifecycle) on Spark.

Every operator is a DataFrame -> DataFrame transform.  Per-symbol sequential
work is split into bounded row blocks (see ``operators.sequence``) so that a
symbol holding a large share of all rows is still spread over many tasks.
"""

import sys

from pyspark import cloudpickle

# Python UDFs of this package are shipped by value with each task, so
# executors need no installed copy of the package (or the driver's cwd).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from candlewick.session import get_spark, checkpoint_dir  # noqa: E402,F401

__all__ = ["get_spark", "checkpoint_dir"]
