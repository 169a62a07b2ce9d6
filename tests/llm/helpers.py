"""Inputs and brute-force versions for the operators' tests."""

from pyspark.sql import functions as F

LONG = "word " * 60_000 + "end"
TEXTS = [(1, "Plain text, of some words. And a second sentence!"), (1, "Plain text, of some words. And a second sentence!"),
         (2, None), (3, ""), (4, " \t\n "), (5, LONG), (6, "ÄÖ ß – 日本語 \x00   <|endoftext|> <s> 😀"),
         (None, "A row without an id"), (None, None), (7, "Plain text, of some words. And a second sentence!"),
         (8, "x" * 100_000)]
#: Names that the operators use inside, or give to their results.
CLASHES = ["fp", "Block", "shard", "_fp", "contamination", "n_tokens", "ids", "score", "_bad", "train", "root", "_x",
           "features", "prediction", "cell", "slot"]


def edge_docs(spark, clashes=True):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    for c in CLASHES if clashes else []:
        df = df.withColumn(c, F.lit(f"own {c}"))
    return df


def empty_docs(spark):
    return edge_docs(spark).where("doc_id = -1")


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]
