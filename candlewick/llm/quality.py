"""Quality classifier by positive-unlabelled learning.

Trusted positives (label 1) and unlabelled web text train a scorer; negative
labels are not used.  The unlabelled sample is a mixture, of which a share
``prior`` is positive.  The negative risk is thus the unlabelled risk less the
prior's share of the positives' risk; that difference cannot truly be
negative, so where it falls below zero it is pushed back (non-negative
unbiased risk).

The class prior is estimated from the data: scores of a first model (positives
against unlabelled) are cut where the ratio of unlabelled to positive rows
above the cut, with a confidence bound for few rows, is smallest.

Scorer: logistic in piecewise-linear features.  Dense text statistics are cut
at quantiles of the unlabelled sample, and every step has a weight.

Bounded sample: the fit uses at most about ``sample`` positives and as many
unlabelled rows (documented parameter), picked by hashes of id and text; rows
equal in both are one, so the bound holds however often an id or a row repeats.
Only the sample's dense statistics, never texts, reach the driver.  Scoring
covers all rows and whole texts.

Edge cases: null and empty texts have all statistics zero and get a score like
any other text.  A document labelled more than once is positive if all its
labels are 1; null labels count as none.  Without positives or without texts
the model scores 0.5.  Other columns pass through; a column named like the
output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import bounded_batches

SAMPLE = 20_000
CUTS = 24
STEPS, BATCH, RATE, DECAY = 800, 4_096, 0.05, 1e-4

STATISTICS = ("words", "bytes", "word_length", "upper", "digit", "sentence_marks", "exclamations", "symbols", "pipes",
              "non_ascii", "distinct_words", "repeated_words", "longest_run", "commonest_word", "capital_words",
              "symbol_ends", "exclamation_ends", "bare_capitals", "lines", "line_words", "repeated_lines",
              "open_lines", "sentence_words")

# byte classes
_OTHER, _UPPER, _LOWER, _DIGIT, _SPACE, _MARK, _EXCLAMATION, _PIPE, _SYMBOL, _HIGH = range(10)


def _classes():
    import numpy as np

    table = np.full(256, _OTHER, np.uint8)
    table[128:] = _HIGH
    for chars, c in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), (b"abcdefghijklmnopqrstuvwxyz", _LOWER),
                     (b"0123456789", _DIGIT), (b" \t\n\r\v\f", _SPACE), (b".,;:?'\"()-", _MARK), (b"!", _EXCLAMATION),
                     (b"|", _PIPE), (b"#$%&*+/<=>@[\\]^_`{}~", _SYMBOL)):
        table[list(chars)] = c
    return table


def statistics(text: str | None, table) -> list[float]:
    """The dense statistics of one whole text, in the order of STATISTICS."""
    import numpy as np

    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    kind = table[np.frombuffer(raw, np.uint8)]
    count = np.bincount(kind, minlength=10)
    blank = kind == _SPACE
    inner = ~blank
    ends = np.flatnonzero(inner & np.append(blank[1:], True))
    starts = np.flatnonzero(inner & np.insert(blank[:-1], 0, True))
    letters = max(1, int(count[_UPPER] + count[_LOWER] + count[_HIGH]))
    size = max(1, int(inner.sum()))
    last = np.bincount(kind[ends], minlength=10)
    # words without a lower-case letter that have two capitals or more
    sums = np.cumsum(np.stack([kind == _UPPER, kind == _LOWER]), axis=1, dtype=np.int32)
    inside = sums[:, ends] - sums[:, starts] + np.stack([kind[starts] == _UPPER, kind[starts] == _LOWER])
    shout = int(((inside[0] >= 2) & (inside[1] == 0)).sum())
    same = np.fromiter(map(bytes.__eq__, words, words[1:]), bool, n - 1)
    run = 0
    if same.any():
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
        run = int((edges[1::2] - edges[::2]).max())
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    marks = raw.count(b".") + raw.count(b"!") + raw.count(b"?")
    return [
        np.log1p(n), np.log1p(len(raw)), size / n, count[_UPPER] / letters, count[_DIGIT] / size, count[_MARK] / size,
        count[_EXCLAMATION] / size, count[_SYMBOL] / size, count[_PIPE] / size, count[_HIGH] / size,
        len(seen) / n, same.sum() / n, run / n, max(seen.values()) / n, shout / n,
        last[_SYMBOL] / n, last[_EXCLAMATION] / n, (kind[starts] == _UPPER).sum() / n,
        np.log1p(len(lines)), np.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines),
        sum(x.rstrip()[-1:] not in b".!?\"'" for x in lines) / len(lines), np.log1p(n / (1 + marks))]


@dataclass
class Model:
    """Knots of each statistic, a weight for each step between them, a bias."""
    knots: list  # [statistic][knot]
    weights: object
    bias: float
    prior: float

    def design(self, x):
        """Where each value lies between the knots: one column a step, 0 to 1."""
        import numpy as np

        cols = []
        for j, k in enumerate(self.knots):
            for a, b in zip(k[:-1], k[1:]):
                cols.append(np.clip((x[:, j] - a) / (b - a), 0.0, 1.0))
        return np.stack(cols, axis=1).astype(np.float32) if cols else np.zeros((len(x), 0), np.float32)

    def scores(self, x):
        import numpy as np

        f = self.design(x) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(f.astype(np.float64), -30, 30)))


def _knots(x) -> list:
    import numpy as np

    return [np.unique(np.quantile(c, np.linspace(0, 1, CUTS + 1))) for c in x.T]


def _descend(design_p, design_u, gradient, steps: int = STEPS):
    """Adam on weights and bias over minibatches; ``gradient(fp, fu)`` gives
    the risk's derivative by the scores of positive and unlabelled rows."""
    import numpy as np

    d, rng = design_p.shape[1], np.random.default_rng(0)
    w, m, v = np.zeros(d + 1), np.zeros(d + 1), np.zeros(d + 1)
    for t in range(1, steps + 1):
        p, u = (x if len(x) <= BATCH else x[rng.integers(0, len(x), BATCH)] for x in (design_p, design_u))
        w32 = w[:d].astype(np.float32)
        gp, gu = gradient((p @ w32).astype(np.float64) + w[d], (u @ w32).astype(np.float64) + w[d])
        g = np.append(p.T @ gp.astype(np.float32) + u.T @ gu.astype(np.float32), gp.sum() + gu.sum()).astype(np.float64)
        g[:d] += DECAY * w[:d]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        rate = RATE * min(1.0, 2 * (1 - (t - 1) / steps))  # falls to zero over the second half
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:d].astype(np.float32), float(w[d])


def _sigmoid(f):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def estimate_prior(positive, unlabelled, delta: float = 0.1) -> float:
    """Share of positives among the unlabelled, from scores of rows that the
    scorer was not fitted on."""
    import numpy as np

    cuts = np.quantile(positive, np.linspace(0, 0.99, 200))
    p = 1 - np.searchsorted(np.sort(positive), cuts, side="left") / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts, side="left") / len(unlabelled)
    doubt = np.sqrt(np.log(4 / delta) / 2) * (len(positive) ** -0.5 + len(unlabelled) ** -0.5)
    best = int(np.argmin((u + doubt) / np.maximum(p, 1e-9)))
    return float(np.clip(u[best] / p[best], 0.01, 0.99))


def fit_rows(positive, unlabelled) -> Model:
    """Fit on statistics of positive and of unlabelled rows."""
    import numpy as np

    p, u = np.asarray(positive, np.float64), np.asarray(unlabelled, np.float64)
    if len(p) < 2 or len(u) < 2:
        return Model([], np.zeros(0, np.float32), 0.0, 0.5)
    model = Model(_knots(np.concatenate([u, p])), None, 0.0, 0.5)
    dp, du = model.design(p), model.design(u)

    # the prior: positives against unlabelled on one half, the ratio on the other
    half_p, half_u = np.arange(len(p)) % 2 == 0, np.arange(len(u)) % 2 == 0
    w, b = _descend(dp[half_p], du[half_u],
                    lambda fp, fu: (-_sigmoid(-fp) / len(fp), _sigmoid(fu) / len(fu)), STEPS // 2)
    prior = estimate_prior(dp[~half_p] @ w + b, du[~half_u] @ w + b)

    def gradient(fp, fu):
        # logistic loss: l(f, +) = log(1 + e^-f), l(f, -) = log(1 + e^f)
        sp, su = _sigmoid(fp), _sigmoid(fu)
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        if negative >= 0:
            return np.full(len(fp), -prior / len(fp)), su / len(fu)
        return prior * sp / len(fp), -su / len(fu)  # the negative risk goes back up to zero

    weights, bias = _descend(dp, du, gradient)
    return Model(model.knots, weights, bias, prior)


# ---------------------------------------------------------------- Spark

def with_statistics(df: DataFrame, text: str, out: str) -> DataFrame:
    bounded_batches(df.sparkSession)

    @F.arrow_udf("array<double>")
    def measured(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = _classes()
        for texts in it:
            yield pa.array([statistics(t.as_py(), table) for t in texts], pa.list_(pa.float64()))

    return df.withColumn(out, measured(F.col(text)))


def picked(by: list[str], wanted: int, there: int, salt: str) -> Column:
    """The hash of a row's columns ``by`` is among the first wanted / there of all."""
    share = 1.0 if there <= wanted else wanted / there
    return F.pmod(F.xxhash64(*by, F.lit(salt)), F.lit(1 << 30)) < int(share * (1 << 30))


def bounded(rows: DataFrame, wanted: int, salt: str) -> DataFrame:
    """About ``wanted`` rows at most, whatever repeats; equal rows are one."""
    return rows.where(picked(rows.columns, wanted, rows.count(), salt)).dropDuplicates()


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, id_col: str = "doc_id", text: str = "text",
        label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on trusted positives and unlabelled rows.  ``train``, a condition on
    ``id_col``, says which rows may be learned from."""
    use = F.lit(True) if train is None else train
    rows = docs.select(id_col, text).where(use)
    positives = (labels.where(use & F.col(label).isNotNull()).groupBy(id_col)
                 .agg(F.min(label).alias("_label")).where("_label = 1").select(id_col))
    some_p = positives.where(picked([id_col], sample, positives.count(), "positive"))
    # broadcast: about ``sample`` ids, whatever the size of the tables; an id may have many rows
    some_p = bounded(rows.join(F.broadcast(some_p), id_col, "left_semi"), sample, "rows of positives")
    some_u = bounded(rows, sample, "unlabelled")

    def matrix(df: DataFrame) -> list:
        # a stable order: the fit must not depend on that of the tasks
        got = with_statistics(df, text, "_x").select(F.xxhash64(id_col).alias("_h"), "_x").collect()
        return [r["_x"] for r in sorted(got, key=lambda r: (r["_h"], r["_x"]))]

    return fit_rows(matrix(some_p), matrix(some_u))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "quality_score") -> DataFrame:
    """Add column ``out``: the probability (0 to 1) that the text is good."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        table, model = _classes(), shared.value
        for texts in it:
            x = np.array([statistics(t.as_py(), table) for t in texts], np.float64).reshape(-1, len(STATISTICS))
            yield pa.array(model.scores(x), pa.float64())

    return docs.withColumn(out, scored(F.col(text)))
