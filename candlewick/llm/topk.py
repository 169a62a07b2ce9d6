"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to integers.  The index holds blocks of rows ordered by
id; of each block, every dimension is kept as bit slices: bitmap (d, b) has
the rows whose value in dimension d, less the block's smallest, has bit b.

A query's score is a sum of shifted slices.  Its components are written in
signed digits (no two neighbours set); digit +2^i adds the dimension's slices
at weight i, digit -2^i adds their complements and a constant.  Slices of
equal weight are added by carry-save adders, three bitmaps to one and a carry
of the next weight, for all rows of a block at once.  The top rows are then
chosen from the most significant sum slice downward: a slice splits the
candidates into rows that have the bit and rows that have not; whichever side
holds the k-th row goes on.  Rows that still tie after the last slice are the
boundary; those with the smallest ids fill the places left.  Scores of chosen
rows are read back from the sum slices, so they are exact.

Each (row block, group of queries) is one task's unit and bounded on both
sides.  A unit returns k rows for each query; a window with a group limit
merges these.  The work is queries x rows by definition of the search; no pair
is materialised.

Edge cases: vectors that are null or hold null or non-finite components take
no part, nor do rows with a null id.  A shorter vector counts as padded with
zeros; an empty one scores 0.  Ties go to the smaller id.  Repeated equal rows
are one query, and each a candidate of others; rows with the query's id are
its own.  Rows that share an id but not the vector are queries of their own,
with a ranking each under that id.  Empty tables give an empty result; other columns are not read.
Scores need to fit in 62 bits, which is checked.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import bounded_batches
from candlewick.session import materialize

ROWS = 16_384      # of an index block
QUERIES = 2_048    # of a unit, at most
SCALE = 256

_INDEX = "block int, ids binary, low binary, slices binary, bits int"
_FOUND = "query_id long, query long, vec_id long, score long"


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as a long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    def bad(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vector.isNotNull() & ~F.exists(vector, bad)


def _matrix(col, dims: int | None = None):
    """A list column as an integer matrix, short rows padded with zeros."""
    import numpy as np

    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    sizes = np.asarray(col.value_lengths(), np.int64)
    flat = np.asarray(col.flatten(), np.int64)
    d = max(dims or 0, int(sizes.max()) if len(sizes) else 0)
    out = np.zeros((len(sizes), d), np.int64)
    out[np.arange(d)[None, :] < sizes[:, None]] = flat
    return out


def build_block(key, rows):
    """Bit slices of one block of rows: [dimension, bit, word]."""
    import numpy as np

    ids = np.asarray(rows["id"].combine_chunks(), np.int64)
    order = np.argsort(ids, kind="stable")
    x = _matrix(rows["v"])[order]
    low = x.min(axis=0)
    u = (x - low).astype(np.uint64)
    bits = max(1, int(u.max()).bit_length() if u.size else 1)
    words = -(-len(ids) // 64)
    slices = np.zeros((x.shape[1], bits, words * 8), np.uint8)
    for b in range(bits):
        packed = np.packbits((u >> np.uint64(b) & np.uint64(1)).astype(np.uint8).T, axis=1, bitorder="little")
        slices[:, b, :packed.shape[1]] = packed
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "ids": pa.array([ids[order].tobytes()], pa.binary()),
                     "low": pa.array([low.tobytes()], pa.binary()), "slices": pa.array([slices.tobytes()], pa.binary()),
                     "bits": pa.array([bits], pa.int32())})


def signed_digits(values) -> list[tuple[int, int, list[int]]]:
    """(i, sign, dimensions) of the digits sign * 2^i in non-adjacent form."""
    found: dict[tuple[int, int], list[int]] = {}
    for d, x in enumerate(values):
        x, i = int(x), 0
        while x:
            if x & 1:
                digit = 2 - (x & 3)
                found.setdefault((i, digit), []).append(d)
                x -= digit
            x >>= 1
            i += 1
    return [(i, s, dims) for (i, s), dims in sorted(found.items())]


def _added(columns: dict) -> list:
    """Sum slices of the bitmaps in ``columns`` (weight -> [n, words])."""
    import numpy as np

    out, k = [], 0
    while k <= max(columns, default=-1):
        stack = columns.pop(k, [])
        col = np.concatenate(stack) if len(stack) > 1 else (stack[0] if stack else None)
        while col is not None and len(col) > 1:
            m = max(1, len(col) // 3)
            a, b = col[:m], col[m:2 * m]
            if len(col) == 2:
                carry, col = a & b, a ^ b
            else:
                c, rest = col[2 * m:3 * m], col[3 * m:]
                x = a ^ b
                carry = a & b
                carry |= c & x
                x ^= c
                col = np.concatenate([x, rest]) if len(rest) else x
            columns.setdefault(k + 1, []).append(carry)
        out.append(None if col is None else col[0])
        k += 1
    return out


def search_block(block: dict, qid: int, q, k: int):
    """(ids, scores) of the block's best ``k`` rows for one query."""
    import numpy as np

    ids, low, slices, flipped, bits = (block[x] for x in ("ids", "low", "slices", "flipped", "bits"))
    q = [int(x) for x in q]
    if sum(abs(x) for x in q) * max(1, block["largest"]) >= 1 << 62:
        raise OverflowError("an inner product does not fit in 62 bits")
    d = min(len(q), len(low))
    base, columns = sum(q[j] * int(low[j]) for j in range(d)), {}
    for i, sign, dims in signed_digits(q[:d]):
        src = slices if sign > 0 else flipped
        if sign < 0:
            base -= len(dims) * ((1 << bits) - 1) << i
        part = src[dims]
        for b in range(bits):
            columns.setdefault(i + b, []).append(part[:, b])
    sums = _added(columns)
    left = block["all"].copy()
    a, z = np.searchsorted(ids, [qid, qid + 1])
    for r in range(a, z):  # the query's own rows
        left[r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
    sure, n_sure = np.zeros_like(left), 0
    for s in reversed(sums):
        if s is None:
            continue
        ones = left & s
        n = int(np.bitwise_count(ones).sum())
        if n_sure + n > k:
            left = ones
        elif n_sure + n == k:
            sure |= ones
            n_sure, left = k, np.zeros_like(left)
            break
        else:
            sure |= ones
            n_sure += n
            left &= ~s
    rows = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
    ties = np.flatnonzero(np.unpackbits(left.view(np.uint8), bitorder="little"))[:k - n_sure]  # smallest ids first
    rows = np.concatenate([rows, ties])
    scores = np.full(len(rows), base, np.int64)
    word, bit = rows >> 6, (rows & 63).astype(np.uint64)
    for j, s in enumerate(sums):
        if s is not None:
            scores += (s[word] >> bit & np.uint64(1)).astype(np.int64) << j
    return ids[rows], scores


def load_block(row: dict) -> dict:
    import numpy as np

    ids, low = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["low"], np.int64)
    words, bits = -(-len(ids) // 64), row["bits"]
    slices = np.frombuffer(row["slices"], np.uint64).reshape(len(low), bits, words)
    every = np.zeros(words * 64, np.uint8)
    every[:len(ids)] = 1
    largest = int(np.abs(low).max()) + (1 << bits) if len(low) else 0
    return {"ids": ids, "low": low, "slices": slices, "flipped": ~slices, "bits": bits, "largest": largest,
            "all": np.packbits(every, bitorder="little").view(np.uint64)}


def build_index(vectors: DataFrame, id_col: str, vector: str, rows: int = ROWS, scale: int = SCALE) -> DataFrame:
    """The index: one row per block of about ``rows`` rows."""
    bounded_batches(vectors.sparkSession)
    use = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector))).select(
        F.col(id_col).cast("long").alias("id"), quantised(F.col(vector), scale).alias("v"))
    blocks = max(1, -(-use.count() // rows))
    return materialize(use.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))
                       .groupBy("block").applyInArrow(build_block, _INDEX))


def top_k(index: DataFrame, queries: DataFrame, id_col: str, vector: str, k: int, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of every query."""
    spark = queries.sparkSession
    asked = materialize(queries.where(F.col(id_col).isNotNull() & usable(F.col(vector))).select(
        F.col(id_col).cast("long").alias("query_id"), quantised(F.col(vector), scale).alias("q")).distinct()
        .withColumn("query", F.xxhash64("q")))
    last = index.agg(F.max("block")).head()[0]
    n_blocks, n_queries = (0 if last is None else last + 1), asked.count()
    # enough units for every core, none with more queries than its bound
    cores = spark.sparkContext.defaultParallelism
    groups = max(1, -(-n_queries // QUERIES), min(n_queries, -(-2 * cores // max(1, n_blocks))))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query_id", "q"), F.lit(groups)).cast("int"))

    def search(key, left, right):
        import numpy as np

        out = ([], [], [], [])
        for row in right.to_pylist():
            block = load_block(row)
            for qid, query, q in zip(*(left[c].to_pylist() for c in ("query_id", "query", "q"))):
                ids, scores = search_block(block, qid, q, k)
                for col, x in zip(out, (np.full(len(ids), qid, np.int64), np.full(len(ids), query, np.int64), ids, scores)):
                    col.append(x)
        cols = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        return pa.table(dict(zip(("query_id", "query", "vec_id", "score"), (pa.array(c, pa.int64()) for c in cols))))

    # queries, in groups, go to every block; index blocks go to every group of queries
    # (a block without rows has no index and finds nothing)
    to_blocks = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(0, n_blocks - 1)))))
    numbered = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = (to_blocks.groupBy("block", "part").cogroup(numbered.groupBy("block", "part"))
             .applyInArrow(search, _FOUND))
    best = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
