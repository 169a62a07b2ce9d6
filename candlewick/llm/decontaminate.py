"""Benchmark decontamination by one Aho-Corasick automaton.

Texts are normalised alike on both sides: A-Z lower-cased, cut into words
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` (digits, letters a-z and everything
beyond ASCII), joined by single spaces.  A window is ``words`` consecutive
words of a benchmark item; an item with fewer words, but not none, is one
window.  All windows go into one automaton with a space at either end, so that
matches begin and end at words.  Each document is normalised and scanned once;
match positions lead back to word numbers, and these to character offsets in
the original text.

Size bound: the automaton is built from a stated set of test items in blocks
of at most ``block_windows`` windows and ``block_bytes`` bytes of windows and
ids (a worker holds some 50 times that).  A benchmark within one block is one
scan.  A larger one is handled block by block, each in a job of its own over
the materialised rows.  Words, items and spans are derived from the hits of all
blocks together, so their number changes no result.

Edge cases: null and empty texts have no words and no hits; a null or empty
item has no window; items with a null id mark hits but are not listed; a
repeated item id counts once.  An empty benchmark or table is fine.  Other
columns pass through; a column named like the output is replaced.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import bounded_batches, free_name, worker_cache
from candlewick.session import materialize

WORDS = 10
BLOCK_WINDOWS = 1_000_000
BLOCK_BYTES = 8 << 20

# Fixed value: the word pattern, on UTF-8 bytes (bytes from \x80 up belong to words).
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

_RESULT = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.string())),
                     ("full", pa.bool_())])
_RESULT_DDL = "struct<n_words: bigint, hits: array<int>, items: array<string>, full: boolean>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_SPANS_DDL = "array<struct<start: int, end: int>>"


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode().lower()) if text else []


def windows_of(words: list[bytes], n: int) -> set[bytes]:
    if not words:
        return set()
    return {b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))}


def _blocks(items: DataFrame, item_id: str, text: str, n: int, limit: int, limit_bytes: int) -> Iterator[dict]:
    """Windows with the ids of their items, within the two limits (an item may be in several blocks)."""
    block: dict[str, set] = {}
    n_blocks = size = 0
    for row in items.select(F.col(item_id).cast("string"), F.col(text)).toLocalIterator():
        for w in windows_of(words_of(row[1]), n):
            w, before = w.decode("latin-1"), len(block)
            ids = block.setdefault(w, set())
            size += len(w) * (len(block) - before)
            if row[0] is not None and row[0] not in ids:
                ids.add(row[0])
                size += len(row[0])
            if len(block) >= limit or size >= limit_bytes:
                yield block
                block, size, n_blocks = {}, 0, n_blocks + 1
    if block or not n_blocks:
        yield block


def _automaton(block: dict):
    import ahocorasick

    found = ahocorasick.Automaton()
    for w, ids in block.items():
        found.add_word(f" {w} ", (w.count(" ") + 1, tuple(ids)))
    if block:
        found.make_automaton()
    return found


def spans(text: str | None, hits: list[int] | None) -> list[dict]:
    """Character offsets of the runs of hit words."""
    import numpy as np

    if not text or not hits:
        return []
    raw, hits = text.encode(), sorted(hits)
    at = [m.span() for m in WORD.finditer(raw.lower())]
    begins = np.frombuffer(raw, np.uint8) & 0xC0 != 0x80  # the first byte of each character
    chars = np.concatenate([[0], np.cumsum(begins)])
    out, i = [], 0
    while i < len(hits):
        j = i
        while j + 1 < len(hits) and hits[j + 1] == hits[j] + 1:
            j += 1
        out.append({"start": int(chars[at[hits[i]][0]]), "end": int(chars[at[hits[j]][1]])})
        i = j + 1
    return out


def scan(text: str | None, automaton, n: int = WORDS) -> dict:
    """One document: its words, the numbers of hit words, items, and whether a
    window of ``n`` words is among the hits."""
    import numpy as np

    raw = (text or "").encode()
    words = WORD.findall(raw.lower())
    out = {"n_words": len(words), "hits": [], "items": [], "full": False}
    if not words or not len(automaton):
        return out
    line = b" %b " % b" ".join(words)
    found = list(automaton.iter(line.decode("latin-1")))
    if found:
        spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        edge = np.zeros(len(words) + 1, np.int64)
        items: set = set()
        # the space at which a match ends follows its last word
        last = np.searchsorted(spaces, [end for end, _ in found])
        for end, (_, (size, ids)) in zip(last, found):
            edge[end - size] += 1
            edge[end] -= 1
            items.update(ids)
        out["hits"] = np.flatnonzero(np.cumsum(edge)[:-1]).tolist()
        out["items"] = sorted(items)
        out["full"] = any(size == n for _, (size, _) in found)
    return out


def _scanner(shared, n: int):
    name = uuid.uuid4().hex

    @F.arrow_udf(_RESULT_DDL)
    def scanned(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        store, at = worker_cache(), ("decontaminate", name)
        if at not in store:
            store.clear()
            store[at] = _automaton(shared.value)
        for texts in it:
            yield pa.array([scan(t.as_py(), store[at], n) for t in texts], _RESULT)
    return scanned


def _locator():
    @F.arrow_udf(_SPANS_DDL)
    def located(texts: pa.Array, hits: pa.Array) -> pa.Array:
        return pa.array([spans(t, h) for t, h in zip(texts.to_pylist(), hits.to_pylist())], _SPANS)
    return located


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", words: int = WORDS, block_windows: int = BLOCK_WINDOWS,
                  out: str = "contamination", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add struct column ``out``: n_words, n_hit, n_items, items (ids sorted as
    strings), spans (character offsets in the original text), contaminated, and
    full (a window of ``words`` words is hit, not only shorter items)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    df, parts = docs, []
    for block in _blocks(benchmark, item_id, item_text, words, block_windows, block_bytes):
        if parts:
            df = materialize(df)  # one automaton in a worker at a time
        parts.append(free_name(df, f"_scan{len(parts)}"))
        df = df.withColumn(parts[-1], _scanner(spark.sparkContext.broadcast(block), words)(F.col(text)))

    def all_of(field: str):
        cols = [F.col(p)[field] for p in parts]
        return cols[0] if len(cols) == 1 else F.array_distinct(F.concat(*cols))

    items, hits = F.array_sort(all_of("items")), all_of("hits")
    n_hit = F.size(hits).cast("long")
    return df.withColumn(out, F.struct(
        F.col(parts[0])["n_words"].alias("n_words"), n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), items.alias("items"),
        _locator()(F.when(n_hit > 0, F.col(text)), hits).alias("spans"), (n_hit > 0).alias("contaminated"),
        reduce(Column.__or__, [F.col(p)["full"] for p in parts]).alias("full"))).drop(*parts)
