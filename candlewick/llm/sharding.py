"""Sharding by a hierarchical weighted hash tree (native expressions only).

A tree has three levels: region, rack and shard.  A row descends from the
root; at each level every child draws an exponential variate
``-ln(u(key, child)) / weight`` from the hash of the key and the child's id,
and the smallest draw wins.  A child's chance is its weight's share, and a
draw depends on nothing but key, child and weight: when a weight changes, rows
move only into or out of the child whose weight changed, on the levels above
that shard.  Opening a new region changes no other draw, so rows move into the
new region alone.

Laws and edge cases
-------------------
* Law ``key``: the key and the number of shards decide, nothing else.
  ``default_tree(n)`` puts the first ``FIRST`` shards into regions and racks;
  every shard after them is a region of its own, so going from any ``n`` to
  n + 1 changes no other draw and takes rows only into the new shard.  Fewer
  shards than ``FIRST`` are a ValueError: pass the number that a smaller
  cluster starts with as ``first``, and keep it.
* Rows with equal keys share a shard; a null key is a key like any other.
* ``slots`` numbers the rows of each shard from 0 without gaps.  It never
  orders a whole shard in one task: rows are counted per (shard, bucket), a
  prefix sum over these few counts gives each bucket's first slot, and
  ``row_number`` runs inside a bucket.  Buckets grow in number with the rows.
* Null text has size 16 and crc32 0; an empty table gives an empty result.
  Columns of the input other than the key are passed through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import free_name
from candlewick.session import materialize

RACKS, SHARDS = 4, 5  # of a region, of a rack
FIRST = 40            # shards that a cluster starts with
ROWS_PER_BUCKET = 20_000


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int  # numbered through all regions
    shard: int
    weight: float = 1.0


def default_tree(n_shards: int, first: int = FIRST) -> list[Leaf]:
    """Equal weights.  The first shards fill regions and racks one after
    another, each later one opens a region."""
    if not 0 < first <= n_shards:
        raise ValueError(f"{n_shards} shards, but the cluster starts with {first}: movement would not be confined")
    regions, racks = -(-first // (RACKS * SHARDS)), -(-first // SHARDS)
    return ([Leaf(s // (RACKS * SHARDS), s // SHARDS, s) for s in range(first)]
            + [Leaf(regions + i, racks + i, first + i) for i in range(n_shards - first)])


def _children(tree: list[Leaf], parent: str | None, child: str) -> dict[int, dict[int, float]]:
    out: dict[int, dict[int, float]] = {}
    for leaf in tree:
        kids = out.setdefault(getattr(leaf, parent) if parent else 0, {})
        kids[getattr(leaf, child)] = kids.get(getattr(leaf, child), 0.0) + leaf.weight
    return out


def _winner(key: Column, level: str, kids: Column) -> Column:
    """Id of the child with the smallest draw (ties: the smaller id)."""
    def draw(c: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), c["id"]), 11)
        u = (bits.cast("double") + 0.5) / F.lit(float(1 << 53))
        return F.struct((-F.log(u) / c["w"]).alias("draw"), c["id"].alias("id"))
    return F.array_min(F.transform(kids, draw))["id"]


def _literal(kids: dict[int, float]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("id"), F.lit(float(w)).alias("w"))
                     for i, w in sorted(kids.items()) if w > 0])


def place(df: DataFrame, key: Column, tree: list[Leaf], out: str = "shard") -> DataFrame:
    """Add column ``out``: the shard that the key reaches in ``tree``."""
    parent = F.lit(0)
    for above, level in ((None, "region"), ("region", "rack"), ("rack", "shard")):
        # children without weight take nothing, nor do parents that have only such
        by = {p: k for p, k in _children(tree, above, level).items() if any(w > 0 for w in k.values())}
        # one column a level, so that a level's draws are made once
        col = free_name(df, f"_{level}") if level != "shard" else out
        if above is None:
            df = df.withColumn(col, _winner(key, level, _literal(by[0])))
        else:
            entries = [x for p, k in sorted(by.items()) for x in (F.lit(p), _literal(k))]
            df = df.withColumn(col, _winner(key, level, F.element_at(F.create_map(*entries), parent)))
            df = df.drop(above_col)
        parent, above_col = F.col(col), col
    return df


def slots(df: DataFrame, shard: str, order: list[str], n_shards: int, out: str = "slot",
          rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Number the rows of each shard from 0; ``df`` should be materialised
    (it is read three times)."""
    per_shard = -(-df.count() // max(1, n_shards))
    buckets = max(1, -(-per_shard // rows_per_bucket))
    b = free_name(df, "_bucket")
    first = free_name(df, "_first")
    spread = df.withColumn(b, F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(shard).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    firsts = (spread.groupBy(shard, b).agg(F.count(F.lit(1)).alias("_n"))
              .select(shard, b, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(first)))
    inside = F.row_number().over(Window.partitionBy(shard, b).orderBy(*order))
    return (spread.withColumn(out, inside - 1).join(firsts, [shard, b])
            .withColumn(out, (F.col(out) + F.col(first)).cast("long")).drop(b, first))


def shard_documents(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text: str = "text",
                    first: int = FIRST) -> DataFrame:
    """Placement of every document under law ``key``, with its slot and its
    place once one more shard is opened."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_col),
        (F.octet_length(t) + 16).cast("long").alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"))
    rows = place(rows, F.col(id_col), default_tree(n_shards, first), "shard")
    rows = place(rows, F.col(id_col), default_tree(n_shards + 1, first), "grown_shard")
    return slots(materialize(rows), "shard", [id_col, "text_crc32", "size"], n_shards)
