"""Hard-negative mining by a secondary-sort shuffle.

Anchors are a stated query set; all rows are scored against them in blocks.
Vectors are quantised to integers and kept as matrices, one row of a table for
a block of rows or a group of anchors.  A unit of work is one block and one
group; it multiplies the two in tiles of ``TILE`` scores.

Two rounds of units:

1. Positives.  Every unit gives, for each of its anchors, its best ``n_pos``
   rows of the anchor's label; those of all units are merged to the anchor's
   positives.  Each opens a window of scores for its negatives.
2. Negatives.  Every unit gives, for each anchor and positive, its best
   ``n_neg`` rows of another label in the window.  What it leaves out can't be
   among the first ``n_neg`` of all rows, so this is the map-side combiner of
   the shuffle that follows: a unit sends at most n_pos * (n_neg + 1) scores
   an anchor, however many rows it holds.

Then the secondary sort: each score becomes a packed key of fixed width,
(anchor, descending score, negative or positive, id, number of the row), in
bytes whose order is the order wanted.  Rows are dealt by the anchor and sorted
by the key inside their partition, ``repartition`` and ``sortWithinPartitions``
being the DataFrame form of repartitionAndSortWithinPartitions: one shuffle,
sorted on the receiving side, spilling to disk.  A streaming iterator walks
each partition: a positive opens its window, a negative goes to all open
windows that hold its score and still have room, and a new anchor closes them.
It keeps the open windows of one anchor, never its rows.

Edge cases: rows whose id, label or vector is null, or whose vector holds a
null or non-finite component, take no part.  A shorter vector counts as padded
with zeros.  Ties go to the smaller id.  Rows with the anchor's id are its
own, neither positive nor negative.  Rows that repeat a whole row are one row;
rows that share an id but differ in label or vector are rows of their own, and
an anchor each.  Fewer positives or negatives than asked for are all returned;
an anchor without positives returns nothing.  Empty tables give an empty
result; other columns are not read.  Scores need to fit in 62 bits, which is
checked; scores that fit in 53 bits are computed in doubles, exactly.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import bounded_batches, written

ROWS = 16_384       # of a block
ANCHORS = 4_096     # of a group
TILE = 1 << 22      # scores computed at once
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # a negative's score as a percentage of its positive's

_MATRIX = "part int, ids binary, labels binary, matrix binary, width int, dims int"
_HIT = pa.schema([("part", pa.int32()), ("anchor", pa.int32()), ("anchor_id", pa.int64()), ("score", pa.int64()),
                  ("id", pa.int64()), ("row", pa.int64())])
_HIT_DDL = "part int, anchor int, anchor_id long, score long, id long, row long"
_MINED = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()),
                    ("negative_id", pa.int64()), ("positive_score", pa.int64()), ("negative_score", pa.int64())])
_MINED_DDL = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
OUT_ROWS = 16_384   # of a batch of results


def quantised(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vector: Column) -> Column:
    def bad(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vector.isNotNull() & ~F.exists(vector, bad)


def _packed(df: DataFrame, part: Column) -> DataFrame:
    """One row for each ``part``: its ids, labels and vectors in the order of the ids."""
    def pack(key, rows):
        import numpy as np

        ids = np.asarray(rows["id"].combine_chunks(), np.int64)
        labels = np.asarray(rows["label"].combine_chunks(), np.int64)
        col = rows["v"].combine_chunks()
        sizes, flat = np.asarray(col.value_lengths(), np.int64), np.asarray(col.flatten(), np.int64)
        x = np.zeros((len(ids), int(sizes.max(initial=0))), np.int64)
        x[np.arange(x.shape[1])[None, :] < sizes[:, None]] = flat
        order = np.lexsort([*x.T[::-1], labels, ids])  # the same on every run
        most = int(np.abs(x).max(initial=0))
        width = next(w for w in (2, 4, 8) if w == 8 or most < 1 << (8 * w - 1))
        binary = lambda a, w=8: pa.array([a[order].astype(f"i{w}").tobytes()], pa.binary())
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "ids": binary(ids), "labels": binary(labels),
                         "matrix": binary(x, width), "width": pa.array([width], pa.int32()),
                         "dims": pa.array([x.shape[1]], pa.int32())})
    return df.withColumn("part", part).groupBy("part").applyInArrow(pack, _MATRIX)


def _loaded(unit: dict, name: str) -> tuple:
    import numpy as np

    ids = np.frombuffer(unit[f"{name}_ids"], np.int64)
    matrix = np.frombuffer(unit[f"{name}_matrix"], f"i{unit[f'{name}_width']}")
    return ids, np.frombuffer(unit[f"{name}_labels"], np.int64), matrix.reshape(len(ids), unit[f"{name}_dims"])


def _products(anchors, rows):
    """Inner products of two integer matrices, exact."""
    import numpy as np

    d = min(anchors.shape[1], rows.shape[1])
    a, r = anchors[:, :d], rows[:, :d]
    largest = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    bound = largest(a) * largest(r) * d
    if bound >= 1 << 62:
        raise OverflowError("an inner product does not fit in 62 bits")
    if bound < 1 << 53:
        return (a.astype(np.float64) @ r.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ r.astype(np.int64).T


def _best(scores, allowed, k: int):
    """Indices of the ``k`` highest allowed scores, ties to the smaller index
    (blocks are in the order of the ids)."""
    import numpy as np

    at = np.flatnonzero(allowed)
    if len(at) > k:
        s = scores[at]
        edge = np.partition(s, len(s) - k)[len(s) - k]
        at = np.concatenate([at[s > edge], at[s == edge][:k - int((s > edge).sum())]])
    return at[np.lexsort((at, -scores[at]))]


def _units(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int) -> DataFrame:
    """A row for every block and group.  Blocks go to every group and groups to
    every block: work and moves are the query set's size times the rows'."""
    named = lambda df, name: df.select(F.col("part").alias(name), *[
        F.col(c).alias(f"{name}_{c}") for c in df.columns if c != "part"])
    r = named(rows, "block").withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_anchors - 1))))
    a = named(anchors, "group").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))
    n = min(n_rows * n_anchors, 4096)
    return r.repartition(n, "block", "group").join(a.repartition(n, "block", "group"), ["block", "group"])


def _over_units(units: DataFrame, chosen) -> DataFrame:
    """The hits of every unit.  ``chosen(unit, anchor number, scores, same
    label, own)`` gives the numbers of the rows to keep for an anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                unit = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                for cols in _tiles(unit, chosen):
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, _HIT)], schema=_HIT)
    return units.mapInArrow(run, _HIT_DDL)


def _tiles(unit: dict, chosen) -> Iterator[tuple]:
    """A unit's hits (columns of _HIT), one tile of anchors at a time."""
    import numpy as np

    ids, labels, rows = _loaded(unit, "block")
    a_ids, a_labels, anchors = _loaded(unit, "group")
    step = max(1, TILE // max(1, len(ids)))
    for begin in range(0, len(a_ids), step):
        found = []
        for a, s in enumerate(_products(anchors[begin:begin + step], rows), begin):
            hit = chosen(unit, a, s, labels == a_labels[a], ids == a_ids[a])
            found.append((np.full(len(hit), unit["group"]), np.full(len(hit), a), np.full(len(hit), a_ids[a]), s[hit],
                          ids[hit], unit["block"] * (1 << 32) + hit))
        yield tuple(np.concatenate(c) for c in zip(*found))


#: The packed key: anchor (id, group, number in it), flipped score, negative, id, number of the row.
KEY = ">QIIQBQQ"
SIGN = 1 << 63


def packed_key(negative: bool) -> Column:
    """A hit's sort key.  Big-endian with the sign bit flipped, so that bytes
    sort as signed numbers do; the score's bits are inverted to descend."""
    sign = F.lit(-SIGN)
    part = lambda x, digits: F.unhex(F.lpad(F.hex(x), digits, "0"))
    signed = lambda c: F.col(c).bitwiseXOR(sign)
    return F.concat(part(signed("anchor_id"), 16), part(F.col("part"), 8), part(F.col("anchor"), 8),
                    part(F.bitwise_not(signed("score")), 16), part(F.lit(int(negative)), 2), part(signed("id"), 16),
                    part(F.col("row"), 16))


def unpacked(key: bytes) -> tuple:
    """(anchor, anchor id, score, negative, id) of a packed key."""
    import struct

    anchor_id, part, anchor, score, negative, row_id, _ = struct.unpack(KEY, key)
    return (anchor_id, part, anchor), anchor_id - SIGN, SIGN - 1 - score, negative, row_id - SIGN


def stream_windows(keys, n_neg: int, low: int, high: int) -> Iterator[tuple]:
    """Unpacked keys in their order -> rows of _MINED.  Holds the open windows
    of one anchor."""
    at, windows = None, []
    for anchor, anchor_id, score, negative, row_id in keys:
        if anchor != at:
            at, windows = anchor, []
        if not negative:
            windows.append([row_id, score, 0])
            continue
        for w in windows:
            if w[2] < n_neg and low * w[1] <= 100 * score <= high * w[1]:
                w[2] += 1
                yield anchor_id, w[0], w[2], row_id, w[1], score


def mine(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
         n_pos: int = POSITIVES, n_neg: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
         rows: int = ROWS, anchors: int = ANCHORS) -> DataFrame:
    """Hard negatives of the rows where ``anchor`` holds: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.

    ``low`` and ``high`` bound a negative's score in hundredths of its
    positive's; with 0 <= low < high <= 100 a window lies below its positive
    in the stream, and a positive below zero has none."""
    if not 0 <= low < high <= 100:
        raise ValueError("0 <= low < high <= 100")
    spark = vectors.sparkSession
    bounded_batches(spark)
    use = vectors.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & usable(F.col(vector))).select(
        F.col(id_col).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        quantised(F.col(vector), scale).alias("v"), F.coalesce(anchor, F.lit(False)).alias("asked"))
    use = written(use.groupBy("id", "label", "v").agg(F.max("asked").alias("asked")), "negatives-rows")
    n, m = use.agg(F.count(F.lit(1)), F.count_if("asked")).first()
    # enough units for every core
    cores = spark.sparkContext.defaultParallelism
    n_rows = max(1, -(-n // rows))
    n_anchors = max(1, -(-m // anchors), min(m, -(-2 * cores // n_rows)))
    spread = lambda k: F.pmod(F.xxhash64("id", "label", "v"), F.lit(k)).cast("int")
    blocks = written(_packed(use.select("id", "label", "v"), spread(n_rows)), "negatives-blocks")
    groups = written(_packed(use.where("asked").select("id", "label", "v"), spread(n_anchors)), "negatives-anchors")

    def positives(unit, a, scores, same, own):
        return _best(scores, same & ~own, n_pos)

    # the best of all units, at most n_pos of each
    best = Window.partitionBy("part", "anchor").orderBy(F.col("score").desc(), "id", "row")
    chosen = written(_over_units(_units(blocks, groups, n_rows, n_anchors), positives)
                     .withColumn("n", F.row_number().over(best)).where(F.col("n") <= n_pos), "negatives-positives")
    opened = chosen.groupBy("part", "anchor").agg(F.collect_set("score").alias("scores")).groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("anchor", "scores"))).alias("windows"))
    groups = written(groups.join(opened, "part", "left"), "negatives-windows")

    def negatives(unit, a, scores, same, own):
        import numpy as np

        free = ~same & ~own
        found = [_best(scores, free & (-(-low * p // 100) <= scores) & (scores <= high * p // 100), n_neg)
                 for p in dict(unit["group_windows"] or ()).get(a, ()) if p >= 0]
        # a row that several windows of the anchor choose is sent once
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    negative = _over_units(_units(blocks, groups, n_rows, n_anchors), negatives)
    pairs = negative.withColumn("key", packed_key(True)).unionByName(
        chosen.drop("n").withColumn("key", packed_key(False)))
    n_parts = min(4096, max(1, min(m, 2 * cores), m * n_rows * n_pos * (n_neg + 1) // 1_000_000))
    ordered = pairs.select("part", "anchor", "key").repartition(n_parts, "part", "anchor").sortWithinPartitions("key")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (unpacked(k.as_py()) for batch in batches for k in batch.column(0))
        mined = stream_windows(keys, n_neg, low, high)
        while out := list(itertools.islice(mined, OUT_ROWS)):
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _MINED)], schema=_MINED)

    return ordered.select("key").mapInArrow(emit, _MINED_DDL)
