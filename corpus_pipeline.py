"""Corpus pipeline: from raw documents to token ids.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor
kept and returns a DataFrame, which is written as Parquet and reread as the
next stage's ``docs``.  All but the last return the columns of ``documents``.

1. quality: documents that the positive-unlabelled classifier scores below 0.5 go.
2. toxicity: documents with a calibrated toxicity of 0.7 or more go.
3. simhash: one document of each near-duplicate class stays, that of the smallest id.
4. decontamination: documents that hold a full window (ten words) of a benchmark item go; a
   short item ("yes", a name) marks a document but is no reason to drop it.
5. sentencepiece: token ids, checked against the original library.

Null and empty texts pass through the operators like any other (each operator's
docstring has its rule); an empty table gives an empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import quality, toxicity
from candlewick.llm.common import fold, free_name, table, written
from candlewick.llm.decontaminate import decontaminate
from candlewick.llm.queries import TOXIC, tokenizer_path
from candlewick.llm.sentencepiece_codec import encode_checked, n_tokens
from candlewick.llm.simhash import keep_one

GOOD = 0.5


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    score = free_name(docs, "_quality")
    return quality.score(docs, model, out=score).where(F.col(score) >= GOOD).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    score = free_name(docs, "_toxicity")
    return toxicity.score(docs, model, out=score).where(F.col(score) < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = free_name(docs, "_contamination")
    marked = decontaminate(docs, table(spark, sf_dir, "benchmark"), out=found)
    return marked.where(~F.col(found)["full"]).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ids, n_tokens, round_trip and parity (in place of columns of these names)."""
    e = free_name(docs, "_encoded")
    done = encode_checked(docs, tokenizer_path("piece_bpe_32k.model"), out=e)
    return (done.withColumn("ids", F.col(e)["ids"]).withColumn("n_tokens", n_tokens(F.col(e)["ids"]))
            .withColumn("round_trip", F.col(e)["round_trip"]).withColumn("parity", F.col(e)["parity"]).drop(e))


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: The fitted classifiers, XXH64 fingerprints and token ids have no SQL form;
#: tests/llm hold the stages against brute-force versions and held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
