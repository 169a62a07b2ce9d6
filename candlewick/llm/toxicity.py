"""Toxicity by gradient-boosted trees over dense features, isotonically calibrated.

Fit, on a bounded sample of labelled rows (at most about ``sample`` toxic and
as many clean ones, picked by hashes of id and text; rows equal in both are
one, so the bound holds however often an id or a row repeats):

1. Lexicon: words and word beginnings (four and five letters) whose document
   counts among toxic and clean rows differ beyond chance (likelihood-ratio
   test), at most ``LEXICON`` of them, each with its log odds as weight.
2. Dense features of whole texts (FEATURES): lexicon densities, hits near a
   second-person word, capitals, punctuation, obfuscation rates.
3. Gradient-boosted trees (pyspark.ml) on three quarters of the sample.
4. Isotonic regression from the trees' margin to the label on the last
   quarter, which neither lexicon nor trees have seen; rows are weighted so
   that both classes have the shares that they have among all labels.

Scoring reads whole texts of all rows once; the lexicon is broadcast (bounded
by ``LEXICON``), trees and calibration run as pyspark.ml transformers.

Edge cases: null and empty texts have all features zero and get a score.  A
document labelled more than once is toxic if any of its labels is 1; null
labels count as none.  Without rows of both classes the score is the share of
toxic labels, or 0.  Other columns pass through; a column named like the output
is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import bounded_batches, free_name
from candlewick.llm.quality import picked
from candlewick.session import materialize

SAMPLE = 20_000
LEXICON = 4_096
EVIDENCE = 24.0   # of the likelihood-ratio test, about one in a million by chance
NEAR = 5          # words between a hit and a second-person word
TREES, DEPTH, STEP = 20, 4, 0.2
STEMS = (4, 5)

FEATURES = ("hits", "hit_weight", "hit_count", "hit_max", "hit_kinds", "stems", "stem_weight", "stem_count", "stem_max",
            "near_second_person", "near_count", "second_person", "capitals", "capital_words", "punctuation",
            "exclamations", "obfuscated", "obfuscated_hits", "words")

# Second-person words; look-alike characters.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur ya du dich dir dein deine deinen ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros vuestro".split())
LOOK_ALIKE = str.maketrans("013457@$!", "oieastasi")

_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"[^\W\d_][0-9@$!*.\-_]+[^\W\d_][\w@$!*.\-]{0,40}")
_BEFORE = re.compile(r"[\w@$!*.\-]*\Z")


# ---------------------------------------------------------------- features

def _unmasked(token: str, words: dict) -> bool:
    """Whether a token with signs or digits between letters hides a lexicon word."""
    plain = token.lower().strip(".-_!*")
    if plain.translate(LOOK_ALIKE) in words or re.sub(r"[^a-zß-ſ]", "", plain) in words:
        return True
    if "*" in plain:
        shape = re.compile(re.escape(plain).replace(r"\*", "."))
        return any(len(w) == len(plain) and shape.fullmatch(w) for w in words)
    return False


def features(text: str | None, words: dict, stems: dict) -> list[float]:
    """Dense features of one whole text, in the order of FEATURES."""
    from math import log1p

    text = text or ""
    tokens = _WORD.findall(text.lower())
    n = len(tokens)
    if not n:
        return [0.0] * len(FEATURES)
    kinds = set(tokens)
    bad = kinds & words.keys()
    begun = {}
    for w in kinds:
        best = max((stems[w[:k]] for k in STEMS if w[:k] in stems), default=0.0)
        if best:
            begun[w] = best
    second = kinds & SECOND_PERSON
    hits = stem_hits = near = seconds = 0
    weight = stem_weight = 0.0
    if bad or begun or second:
        marked = bad | begun.keys()
        spots = [i for i, w in enumerate(tokens) if w in marked]
        for i in spots:
            w = tokens[i]
            if w in bad:
                hits += 1
                weight += words[w]
            if w in begun:
                stem_hits += 1
                stem_weight += begun[w]
            near += bool(second) and not second.isdisjoint(tokens[max(0, i - NEAR):i + NEAR + 1])
        seconds = sum(w in second for w in tokens) if second else 0
    # from the word's first character on, at most 40 before the match
    masked = [_BEFORE.search(text, max(0, m.start() - 40), m.start())[0] + m[0] for m in _MASKED.finditer(text)]
    hidden = sum(_unmasked(t, words) for t in masked) if words else 0
    letters = sum(map(len, tokens))
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    shouted = sum(len(w) > 1 and w.isupper() for w in text.split())
    marks = sum(map(text.count, ".,;:?!"))
    return [hits / n, weight / n, log1p(hits), max((words[w] for w in bad), default=0.0), log1p(len(bad)),
            stem_hits / n, stem_weight / n, log1p(stem_hits), max(begun.values(), default=0.0),
            near / n, log1p(near), seconds / n, upper / max(1, letters), shouted / n, marks / n,
            text.count("!") / n, len(masked) / n, log1p(hidden), log1p(n)]


def with_features(df: DataFrame, text: str, out: str, lexicon: dict) -> DataFrame:
    bounded_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    @F.arrow_udf("array<double>")
    def measured(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, stems = shared.value["words"], shared.value["stems"]
        for texts in it:
            yield pa.array([features(t.as_py(), words, stems) for t in texts], pa.list_(pa.float64()))

    return df.withColumn(out, measured(F.col(text)))


# ---------------------------------------------------------------- fit

@dataclass
class Model:
    lexicon: dict
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float  # of toxic labels


def mine_lexicon(rows: DataFrame, text: str, label: str, limit: int = LEXICON) -> dict:
    """Words and word beginnings that toxic rows have more often than chance."""
    total = rows.agg(F.coalesce(F.sum(label), F.lit(0)).alias("bad"), F.count(F.lit(1)).alias("all")).head()
    n_bad, n_good = int(total.bad), int(total.all - total.bad)
    if not n_bad or not n_good:
        return {"words": {}, "stems": {}}
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0)))
    terms = [F.transform(found, lambda w: F.struct(F.lit(0).alias("kind"), w.alias("term")))]
    for k in STEMS:
        begun = F.array_distinct(F.transform(F.filter(found, lambda w: F.length(w) >= k), lambda w: F.substring(w, 1, k)))
        terms.append(F.transform(begun, lambda w: F.struct(F.lit(k).alias("kind"), w.alias("term"))))
    counts = (rows.select(F.col(label).alias("bad"), F.explode(F.concat(*terms)).alias("t"))
              .where(F.length("t.term").between(2, 40))
              .groupBy("t").agg(F.sum("bad").cast("double").alias("a"), F.count(F.lit(1)).cast("double").alias("n")))
    p, b = n_bad / (n_bad + n_good), F.col("n") - F.col("a")

    def part(seen: Column, share: float) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (F.col("n") * share))).otherwise(0.0)

    weight = F.log((F.col("a") + 0.5) / (n_bad + 1)) - F.log((b + 0.5) / (n_good + 1))
    best = (counts.withColumn("evidence", 2 * (part(F.col("a"), p) + part(b, 1 - p))).withColumn("weight", weight)
            .where((F.col("evidence") > EVIDENCE) & (F.col("weight") > 1.0))
            .orderBy(F.col("evidence").desc(), "t").limit(limit).collect())
    return {"words": {r.t.term: r.weight for r in best if r.t.kind == 0},
            "stems": {r.t.term: r.weight for r in best if r.t.kind}}


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, id_col: str = "doc_id", text: str = "text",
        label: str = "toxic", sample: int = SAMPLE) -> Model:
    """``train``, a condition on ``id_col``, says which labels may be learned from."""
    use = F.lit(True) if train is None else train
    told = (labels.where(use & F.col(label).isNotNull()).groupBy(id_col)
            .agg((F.max(label) == 1).cast("int").alias("_bad")))
    n = told.agg(F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad"), F.count(F.lit(1)).alias("all")).head()
    n_bad, n_good = int(n.bad), int(n.all - n.bad)
    share = n_bad / n.all if n.all else 0.0
    some = told.where(F.when(F.col("_bad") == 1, picked([id_col], sample, n_bad, "toxic"))
                      .otherwise(picked([id_col], sample, n_good, "clean")))
    # broadcast: about twice ``sample`` ids, whatever the size of the tables; an id may have many rows
    of_ids = docs.select(id_col, text).where(use).join(F.broadcast(some), id_col)
    there = {r["_bad"]: r["n"] for r in of_ids.groupBy("_bad").agg(F.count(F.lit(1)).alias("n")).collect()}
    by = [id_col, text]
    rows = of_ids.where(F.when(F.col("_bad") == 1, picked(by, sample, there.get(1, 0), "rows of toxic"))
                        .otherwise(picked(by, sample, there.get(0, 0), "rows of clean"))).dropDuplicates()
    # in a stable order: trees must not depend on that of the tasks
    rows = rows.sortWithinPartitions(id_col, F.xxhash64(text))
    rows = materialize(rows.withColumn("_part", F.pmod(F.xxhash64(id_col, F.lit("part")), F.lit(4))))
    fitted = rows.where("_part > 0")
    lexicon = mine_lexicon(fitted, text, "_bad")
    per_class = {r["_bad"]: r["n"] for r in rows.where("_part > 0").groupBy("_bad").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(per_class) < 2:
        return Model(lexicon, None, None, share)
    # a row counts for as many labels as the sample has it stand for
    stands = F.when(F.col("_bad") == 1, max(1.0, n_bad / sample)).otherwise(max(1.0, n_good / sample))
    x = materialize(with_features(rows, text, "_x", lexicon).select(
        array_to_vector("_x").alias("_x"), F.col("_bad").cast("double").alias("_bad"), "_part",
        stands.alias("_stands"))).coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    trees = GBTClassifier(featuresCol="_x", labelCol="_bad", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP,
                          seed=0).fit(x.where("_part > 0"))
    held = trees.transform(x.where("_part = 0")).withColumn("_m", vector_to_array(F.col(trees.getRawPredictionCol()))[1])
    if held.select("_bad").distinct().count() < 2:
        return Model(lexicon, trees, None, share)
    calibration = IsotonicRegression(featuresCol="_m", labelCol="_bad", weightCol="_stands", predictionCol="_iso").fit(held)
    return Model(lexicon, trees, calibration, share)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity_score") -> DataFrame:
    """Add column ``out``: the calibrated probability that the text is toxic."""
    if model.trees is None:
        return docs.withColumn(out, F.lit(model.share))
    names = {x: free_name(docs, f"_tox_{x}") for x in ("x", "p", "q", "r", "m", "i")}
    trees = model.trees.copy()
    trees = (trees.setFeaturesCol(names["x"]).setPredictionCol(names["p"]).setProbabilityCol(names["q"])
             .setRawPredictionCol(names["r"]))
    df = with_features(docs, text, names["x"], model.lexicon).withColumn(names["x"], array_to_vector(names["x"]))
    df = trees.transform(df)
    value = vector_to_array(F.col(names["q"]))[1]
    if model.calibration is not None:
        df = df.withColumn(names["m"], vector_to_array(F.col(names["r"]))[1])
        df = model.calibration.copy().setFeaturesCol(names["m"]).setPredictionCol(names["i"]).transform(df)
        value = F.col(names["i"])
    return df.withColumn(out, F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))).drop(*names.values())
