"""Token counts by a map-side two-tier lookup.

A byte-level BPE splits a text into pre-tokens and merges inside each of them,
so a text has as many tokens as its pre-tokens have together.

Tier 1 is a compact hash table of frequent pre-token lengths, broadcast to the
workers.  Its candidates come from heavy-hitter sketches over all texts
(``approx_top_k``), combined in three levels so that no task receives more
than a bounded number of fixed-size sketches.  Tier 2 is a cache in each
Python worker: pre-tokens that the table misses are encoded by the library in
batches and remembered.  The cache is emptied when it reaches
``cache_entries``; that costs time, never a result.  No pre-token is shuffled.

Texts of any script are split, by an engine other than the library's.  The
pattern knows a character only by its class, so the two agree on a text if they
agree on each of its characters; each character outside ``COMMON`` is tested
once in a worker.  Texts that hold a character on which they differ (in newer
versions of Unicode than one of them has), or an added token's string, go whole
to the library.  So every count is the library's.

Edge cases: null text counts as empty and has 0 tokens.  Texts are never
truncated.  An empty table gives an empty result.  Other columns pass through;
a column named like the output is replaced.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import bounded_batches, worker_cache

FREQUENT = 8_192           # entries asked of the sketches (the table's size bound, before splitting)
SKETCH_ITEMS = 16_384      # entries that a sketch tracks
CACHE_ENTRIES = 400_000    # of a worker's cache

# Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters on whose classes the engines agree, so that they need no test:
# printable ASCII, tab, line feed, carriage return, Latin-1 letters and signs,
# Latin Extended-A, the usual typographic quotes, dashes, bullet and ellipsis.
COMMON = r"[\t\n\r\x20-\x7e\xa1-\xac\xae-ſ–—‘’“”•…€]"
OTHERS = COMMON.replace("[", "[^", 1)


def supports(tokenizer_json: str) -> bool:
    """Whether counts add up over pre-tokens: a byte-level BPE that has no
    normaliser and splits by PATTERN."""
    spec = json.loads(tokenizer_json)
    pre = spec.get("pre_tokenizer") or {}
    return (spec["model"]["type"] == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec["model"].get("dropout"))


def _tokenizer(tokenizer_json: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(tokenizer_json)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _lengths(tok, texts: list[str]) -> list[int]:
    return [len(e) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]


def frequent_pieces(df: DataFrame, text: str, k: int = FREQUENT, tracked: int = SKETCH_ITEMS) -> list[str]:
    """The k most frequent space-separated pieces of all texts, about."""
    pieces = df.select(F.explode(F.split(F.col(text), " ", -1)).alias("piece"),
                       F.pmod(F.spark_partition_id(), F.lit(4096)).alias("part"))
    pieces = pieces.where(F.length("piece").between(1, 64))
    level = pieces.groupBy("part").agg(F.expr(f"approx_top_k_accumulate(piece, {tracked})").alias("s"))
    level = level.groupBy(F.pmod("part", F.lit(64)).alias("part")).agg(
        F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"))
    # grouped by a constant: an ungrouped one would also make a sketch of each empty partition, which can't be sent
    level = level.groupBy(F.pmod("part", F.lit(1))).agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"))
    row = level.select(F.expr(f"approx_top_k_estimate(s, {k})").alias("top")).head()
    return [] if row is None else [x["item"] for x in row.top]


class Agreement:
    """Whether splitting here gives the library's pre-tokens."""

    def __init__(self, tok):
        import regex

        self.pre, self.findall = tok.pre_tokenizer, regex.compile(PATTERN).findall
        self.others = regex.compile(OTHERS).findall
        self.tested: dict[str, bool] = {}

    def same_class(self, c: str) -> bool:
        """The character next to a letter, a digit, a sign and a space, each of
        which a character of its own class joins, splits alike."""
        if c not in self.tested:
            probe = f"a{c}1{c}.{c} {c}"
            theirs = [probe[a:b] for _, (a, b) in self.pre.pre_tokenize_str(probe)]
            self.tested[c] = theirs == self.findall(probe)
        return self.tested[c]

    def on(self, text: str) -> bool:
        return all(map(self.same_class, set(self.others(text))))


class _Lengths(dict):
    """Worker cache of pre-token lengths over the broadcast table."""

    def __init__(self, tok, table: dict, entries: int):
        super().__init__(table)
        self.tok, self.table, self.entries = tok, table, entries

    def learn(self, seen: set) -> None:
        new = [t for t in seen if t not in self]
        if len(self) + len(new) > self.entries + len(self.table):
            self.clear()
            self.update(self.table)
            new = [t for t in seen if t not in self]
        for i in range(0, len(new), 4096):
            part = new[i:i + 4096]
            self.update(zip(part, _lengths(self.tok, part)))


def _count(texts: list, tok, cache: _Lengths, agreement: Agreement | None, added: list[str]) -> list[int]:
    out, whole = [0] * len(texts), []
    i = 0
    while i < len(texts):
        # a run of texts of about a megabyte is split, its unseen pre-tokens
        # are encoded together, then it is summed
        run, seen, chars = [], set(), 0
        while i < len(texts) and chars < 1 << 20:
            t = texts[i]
            if t:
                chars += len(t)
                # without the two-tier form's premises every text goes to the library
                if agreement is None or any(a in t for a in added) or not agreement.on(t):
                    whole.append(i)
                else:
                    toks = agreement.findall(t)
                    seen.update(toks)
                    run.append((i, toks))
            i += 1
        cache.learn(seen)
        for j, toks in run:
            out[j] = sum(map(cache.__getitem__, toks))
    for j in whole:  # one at a time: an encoding takes many times its text
        out[j] = _lengths(tok, [texts[j]])[0]
    return out


def count_tokens(df: DataFrame, tokenizer_file: str, text: str = "text", out: str = "n_tokens",
                 frequent: int = FREQUENT, cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """Add column ``out``: the number of tokens of ``text`` without begin, end
    or other added special tokens."""
    spark = df.sparkSession
    bounded_batches(spark)
    with open(tokenizer_file, encoding="utf-8") as f:
        tokenizer_json = f.read()
    added = [a["content"] for a in json.loads(tokenizer_json).get("added_tokens", [])]
    table: dict[str, int] = {}
    exact = supports(tokenizer_json)
    if exact:
        tok = _tokenizer(tokenizer_json)
        agreement = Agreement(tok)
        pieces = [f" {p}" for p in frequent_pieces(df, text, frequent) if agreement.on(p)]
        words = sorted({t for p in pieces for t in agreement.findall(p)})
        table = dict(zip(words, _lengths(tok, words)))
    shared, name = spark.sparkContext.broadcast((tokenizer_json, table)), uuid.uuid4().hex

    @F.arrow_udf("long")
    def counts(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        store = worker_cache()
        at = ("token_count", name)
        if at not in store:
            store.clear()  # one tokenizer at a time
            tok = _tokenizer(shared.value[0])
            store[at] = tok, _Lengths(tok, shared.value[1], cache_entries), Agreement(tok) if exact else None
        tok, cache, agreement = store[at]
        for texts in it:
            yield pa.array(_count(texts.to_pylist(), tok, cache, agreement, added), pa.int64())

    return df.withColumn(out, counts(F.coalesce(F.col(text), F.lit(""))))
