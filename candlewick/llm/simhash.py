"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint has 64 bits: a bit is 1 if it is set in over half of the XXH64
hashes of the text's word shingles (repeats included).  Two documents link
when their fingerprints differ in ``max_bits`` or fewer bits; a class is what
links reach.

Search.  A fingerprint becomes the point of its bit counts in 32 segments of
two bits.  A segment's counts differ by no more than its bits do, so the
Manhattan distance of two points is a lower bound of their Hamming distance.
Links within ``max_bits`` therefore lie within that Manhattan distance; cut
into groups of segments (``max_bits // 2 + 1`` of them, two at least), some group's points
are within distance 1.  A grid range-join on each group finds these: every
fingerprint stands in its own cell and, one row each, in the cells that one
step up in one segment reaches; equal points meet in their own cell, points
one step apart in the upper one's.  Every meeting is then verified on all 64
bits in the join itself, so only links come out.

Exact copies are collapsed before the search: it runs over distinct
fingerprints.  Components are found on links of distinct fingerprints.

Edge cases: a null or empty text, or one of white space, has fingerprint zero
and links like any other; a text with fewer words than a shingle has its whole
word sequence as one shingle.  A class's id is its smallest non-null document
id, null if it has none.  Repeated rows are in one class.  An empty table
gives an empty result; other columns pass through ``fingerprints`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import bounded_batches, free_name, written
from candlewick.llm.components import components
from candlewick.session import materialize

SHINGLE = 3
MAX_BITS = 3
SEED = 42
_ODD = 0x5555555555555555


def shingle_hashes(text: str | None, n: int = SHINGLE, seed: int = SEED) -> list[int]:
    """XXH64 of each shingle; words are split at ASCII white space."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= n:
        return [xxhash.xxh64_intdigest(line, seed)]
    begins, at = [], 0
    for w in words:
        begins.append(at)
        at += len(w) + 1
    ends = [b - 1 for b in begins[n:]] + [len(line)]
    digest = xxhash.xxh64_intdigest
    return [digest(line[b:e], seed) for b, e in zip(begins, ends)]


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    import numpy as np

    h = np.array(shingle_hashes(text, n), ">u8")
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):  # bounded memory for very long texts
        ones += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """Add column ``out``: the fingerprint as a signed long."""
    bounded_batches(df.sparkSession)

    @F.arrow_udf("long")
    def prints(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in it:
            yield pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())

    return df.withColumn(out, prints(F.col(text)))


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _grid(fps: DataFrame, groups: int) -> DataFrame:
    """(fp, group, cell, own): a fingerprint's own cell in each group of
    segments, and the cells one step up."""
    per, rows = -(-32 // groups), []
    for g in range(groups):
        width = min(per, 32 - g * per) * 2
        bits = F.shiftrightunsigned("fp", g * per * 2).bitwiseAND(F.lit((1 << width) - 1))
        odd = F.lit(_ODD & ((1 << width) - 1))  # the low bit of every segment
        name = f"cell{g}"
        fps = fps.withColumn(name, bits.bitwiseAND(odd) + F.shiftrightunsigned(bits, 1).bitwiseAND(odd))
        rows.append(F.struct(F.lit(g).alias("group"), F.col(name).alias("cell"), F.lit(True).alias("own")))
        for s in range(0, width, 2):
            full = F.shiftrightunsigned(name, s + 1).bitwiseAND(F.lit(1)) == 1  # a count of two has no step up
            rows.append(F.when(~full, F.struct(F.lit(g).alias("group"), (F.col(name) + F.lit(1 << s)).alias("cell"),
                                               F.lit(False).alias("own"))))
    return (fps.select("fp", F.explode(F.array_compact(F.array(*rows))).alias("r"))
            .select("fp", "r.group", "r.cell", "r.own"))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): distinct fingerprints of column ``fp`` that differ in
    ``max_bits`` or fewer bits, each pair once or more often."""
    grid = _grid(fps, max(2, max_bits // 2 + 1))
    stands = grid.where("own").select(F.col("fp").alias("a"), "group", "cell")
    reaches = grid.select(F.col("fp").alias("b"), "group", "cell", "own")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    once = ~F.col("own") | (F.col("a") < F.col("b"))
    return stands.join(reaches, (stands["group"] == reaches["group"]) & (stands["cell"] == reaches["cell"])
                       & near & once & (F.col("a") != F.col("b"))).select("a", "b")


def classes(rows: DataFrame, id_col: str, fp: str, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root, component_id, rep): for each fingerprint its class's root
    fingerprint and smallest document id, and whether the document of that id
    is one of this fingerprint's.  ``rows`` should be materialised."""
    fps = materialize(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(id_col).alias("first")))
    found = materialize(components(links(fps, max_bits), "a", "b").withColumnRenamed("node", "fp"))
    rooted = materialize(fps.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    # of fingerprints that hold the smallest id, the smallest one stands for the class
    best = materialize(rooted.groupBy("root").agg(
        F.min(F.struct(F.col("first").isNull().alias("none"), F.col("first"), F.col("fp"))).alias("best")))
    return materialize(rooted.join(best, "root").select(
        "fp", "root", F.col("best.first").alias("component_id"), (F.col("best.fp") == F.col("fp")).alias("rep")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fingerprint as a signed long, component_id), one row per document."""
    rows = materialize(fingerprints(docs.select(id_col, text), text, "_fp", shingle).select(id_col, "_fp"))
    known = classes(rows, id_col, "_fp", max_bits).select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(known, "_fp", "left").select(id_col, F.col("_fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one document of each class: that of the
    smallest id.  Of rows that repeat this id, the one of the smallest
    fingerprint stays, then that of the smallest text hash; of rows equal in
    these the first as numbered when the fingerprints were written.

    Texts are read once for their fingerprints and written beside them; the
    choice is made on (fingerprint, id, text hash, number) alone."""
    fp, row = free_name(docs, "_fp"), free_name(docs, "_row")
    marked = written(fingerprints(docs, text, fp, shingle).withColumn(row, F.monotonically_increasing_id()), "simhash")
    rows = materialize(marked.select(id_col, fp, F.struct(F.xxhash64(text).alias("h"), F.col(row).alias("row")).alias("_key")))
    stay = (classes(rows, id_col, fp, max_bits).where("rep")
            .select(F.col("fp").alias("_stay_fp"), F.col("component_id").alias("_stay_id")))
    met = rows.join(stay, (F.col(fp) == F.col("_stay_fp")) & F.col(id_col).eqNullSafe(F.col("_stay_id")))
    chosen = met.groupBy("_stay_fp").agg(F.min("_key").alias("_key")).select(F.col("_key")["row"].alias(row))
    return marked.join(chosen, row, "left_semi").drop(row, fp).select(*docs.columns)
