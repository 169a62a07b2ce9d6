import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import quality, toxicity
from candlewick.llm.common import fold
from candlewick.llm.queries import op5_quality, op6_toxicity
from tests.conftest import SF01
from tests.llm.helpers import TEXTS, edge_docs, empty_docs


def auc(score, label):
    order = np.argsort(score, kind="stable")
    label = np.asarray(label)[order]
    ranks = np.arange(1, len(label) + 1)
    n1, n0 = label.sum(), (1 - label).sum()
    return (ranks[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


@pytest.mark.parametrize("query,label,cut,least", [(op5_quality, "quality", 0.5, 0.98), (op6_toxicity, "toxic", 0.7, 0.85)])
def test_held_out_accuracy(spark, query, label, cut, least):
    out = query(spark, SF01)
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    got = out.join(labels, "doc_id").where("held_out").collect()
    assert out.count() == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert auc([r.score for r in got], [r[label] for r in got]) > least
    assert np.mean([r.predicted == r[label] for r in got]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= cut) for r in got)


def test_labels_outside_the_training_rows_are_not_used(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    use = fold("doc_id", 3) != 1
    turned = labels.withColumn("quality", F.when(use, F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = (quality.fit(docs, x, use) for x in (labels, turned))
    assert a.prior == b.prior and (a.weights == b.weights).all()


def test_toxic_labels_outside_the_training_rows_are_not_used(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    use = fold("doc_id", 3) != 1
    turned = labels.withColumn("toxic", F.when(use, F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = (toxicity.fit(docs, x, use) for x in (labels, turned))
    assert a.lexicon == b.lexicon and a.share == b.share and a.lexicon["words"]
    assert a.trees.toDebugString.split("\n", 1)[1] == b.trees.toDebugString.split("\n", 1)[1]
    assert (a.calibration.boundaries, a.calibration.predictions) == (b.calibration.boundaries, b.calibration.predictions)


def test_sample_is_bounded_for_repeated_ids_and_rows(spark):
    """A third of the rows has one id, another third is one row: neither fills the sample, nor is it left out."""
    n = 3_000
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(n)] + [(-1, f"text {i}") for i in range(n)]
                                 + [(-2, "the same")] * n, "doc_id long, text string")
    got = quality.bounded(docs, 900, "x").collect()
    assert 500 < len(got) < 700 and len(set(got)) == len(got)  # a tenth of 6,001 distinct rows
    one = sum(r.doc_id == -1 for r in got)
    assert 200 < one < 400 and 200 < sum(r.doc_id >= 0 for r in got) < 400
    assert sorted(got) == sorted(quality.bounded(docs.repartition(7), 900, "x").collect())
    few = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (None, None), (None, None), (2, "")],
                                "doc_id long, text string")
    assert quality.bounded(few, 900, "x").count() == 4


def test_fit_with_repeated_ids(spark):
    """One labelled id with many texts and one row many times: the fits take few of them."""
    docs = spark.createDataFrame([(1, f"Good words, number {i}, stand here.") for i in range(600)] + [(2, "bad bad idiot")] * 600
                                 + [(i, f"Some text {i}.") for i in range(3, 600)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i != 2 and i % 2), int(i == 2 or i % 5 == 0)) for i in range(1, 600)],
                                   "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels, sample=100)
    assert 0 < model.prior < 1
    assert quality.score(docs, model).where("quality_score between 0 and 1").count() == docs.count()
    assert toxicity.score(docs, toxicity.fit(docs, labels, sample=100)).where("toxicity_score between 0 and 1").count() == docs.count()


def test_quality_scores_equal_brute_force(spark):
    """The piecewise-linear scorer by hand: a weight for each step between knots."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    model = quality.fit(spark.read.parquet(f"{SF01}/documents.parquet"), labels, fold("doc_id", 3) != 1)
    table = quality._classes()
    for r in quality.score(docs, model, out="score").collect():
        x, total, i = quality.statistics(r.text, table), model.bias, 0
        for value, knots in zip(x, model.knots):
            for a, b in zip(knots, knots[1:]):
                total += float(model.weights[i]) * min(1.0, max(0.0, (value - a) / (b - a)))
                i += 1
        assert i == len(model.weights)
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-4)


def test_toxicity_scores_equal_brute_force(spark):
    """Trees added up and the isotonic steps interpolated by hand."""
    from pyspark.ml.linalg import Vectors
    every = spark.read.parquet(f"{SF01}/documents.parquet")
    model = toxicity.fit(every, spark.read.parquet(f"{SF01}/labels.parquet"), fold("doc_id", 3) != 1)
    trees, weights = model.trees.trees, model.trees.treeWeights
    steps, values = list(model.calibration.boundaries), list(model.calibration.predictions)
    for r in toxicity.score(every.limit(60), model, out="score").collect():
        x = Vectors.dense(toxicity.features(r.text, model.lexicon["words"], model.lexicon["stems"]))
        margin = sum(w * t.predict(x) for w, t in zip(weights, trees))
        assert r.score == pytest.approx(min(1.0, max(0.0, float(np.interp(margin, steps, values)))), abs=1e-9)


def test_prior_estimate_and_risk():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.8):
        good, bad = rng.normal(2, 1, (6000, 2)), rng.normal(-2, 1, (6000, 2))
        n = int(6000 * share)
        model = quality.fit_rows(good[:3000], np.concatenate([good[-n:], bad[:6000 - n]]))
        assert abs(model.prior - share) < 0.06
        new_good, new_bad = rng.normal(2, 1, (2000, 2)), rng.normal(-2, 1, (2000, 2))
        assert (model.scores(new_good) >= 0.5).mean() > 0.97 and (model.scores(new_bad) < 0.5).mean() > 0.95


def test_statistics_of_plain_cases():
    t = quality._classes()
    s = dict(zip(quality.STATISTICS, quality.statistics("AA!! BB!! cc cc cc\ncc | x###", t)))
    assert s["words"] == pytest.approx(np.log1p(8)) and s["symbol_ends"] == pytest.approx(1 / 8)
    assert s["bare_capitals"] == pytest.approx(2 / 8) and s["exclamation_ends"] == pytest.approx(2 / 8)
    assert s["repeated_words"] == pytest.approx(3 / 8) and s["longest_run"] == pytest.approx(3 / 8)
    assert quality.statistics(None, t) == quality.statistics(" \n", t) == [0.0] * len(quality.STATISTICS)
    assert np.isfinite(quality.statistics("x", t)).all() and np.isfinite(quality.statistics("é" * 9, t)).all()


LABELS = [(1, 1, 0), (1, 1, 1), (2, 0, 0), (3, None, None), (None, 1, 1), (7, 1, 0), (8, 0, 1), (99, 1, 1)]


def test_edges(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    none = labels.where("doc_id = -1")
    for told in (labels, none):
        for op in (quality, toxicity):
            model = op.fit(edge_docs(spark), told)
            got = op.score(edge_docs(spark), model, out="score")
            assert got.columns == edge_docs(spark).columns
            rows = got.collect()
            assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
            assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
            assert op.score(empty_docs(spark), model).count() == 0
            assert op.fit(empty_docs(spark), told) is not None


def test_toxic_features():
    words, stems = {"idiot": 5.0, "trash": 4.0}, {"scum": 3.0}
    f = lambda t: dict(zip(toxicity.FEATURES, toxicity.features(t, words, stems)))
    got = f("You are an IDIOT, scummy one two three four five six trash")
    assert got["hits"] == pytest.approx(2 / 12) and got["hit_max"] == 5 and got["stems"] == pytest.approx(1 / 12)
    assert got["near_second_person"] == pytest.approx(2 / 12) and got["second_person"] == pytest.approx(1 / 12)
    assert got["capital_words"] == pytest.approx(1 / 12)
    for hidden in ("an 1d1ot here", "an id*ot here", "an i.d.i.o.t here", "some tr@sh here"):
        assert f(hidden)["obfuscated_hits"] > 0, hidden
    assert f("a plain well-known text")["obfuscated_hits"] == 0 and set(f(None).values()) == {0.0}
