import hashlib
import re

import pytest

from candlewick.llm.decontaminate import _blocks, decontaminate
from candlewick.llm.queries import op1_decontamination
from tests.conftest import SF001
from tests.llm.helpers import TEXTS, edge_docs, empty_docs

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, items, n=10):
    windows = {}
    for i, t in items:
        w = PATTERN.findall(lower(t))
        for k in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = PATTERN.findall(lower(t)), set(), set()
        for win, ids in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    found |= ids
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    got = [tuple(r) for r in op1_decontamination(spark, SF001).collect()]
    assert sorted(got) == sorted(brute(docs, items))
    assert any(r[-1] for r in got)


ITEMS = [(1, "One two THREE four five six seven eight nine ten eleven"), (2, "short item"), (3, None), (4, " .,! "),
         (None, "item without id"), (1, "One two THREE four five six seven eight nine ten eleven"), (5, "Äpfel, naïve café")]
DOCS = [(1, "x One, two three FOUR five-six seven eight nine ten! y"), (2, "a short item and a short, Item short"),
        (3, "shorter item; short items"), (4, "the item without id"), (5, "Ein Äpfel naïve\ncafé."), (6, "äpfel naïve café"),
        (7, "two three four five six seven eight nine ten eleven twelve")]


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_blocks_and_offsets(spark, block):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r.doc_id: r.contamination for r in decontaminate(docs, items, block_windows=block).collect()}
    for i, n, hit, _, _, bad in brute(DOCS, [x for x in ITEMS if x[0]] + [("", ITEMS[4][1])]):
        assert (got[i].n_words, got[i].n_hit, got[i].contaminated) == (n, hit, bad)
    assert got[1]["items"] == ["1"] and got[2]["items"] == ["2"] and got[4]["items"] == [] and got[4].n_hit == 3
    text = dict(DOCS)
    cut = {i: [text[i][s.start:s.end] for s in c.spans] for i, c in got.items()}
    assert cut[1] == ["One, two three FOUR five-six seven eight nine ten"]
    assert cut[2] == ["short item", "short, Item"] and cut[5] == ["Äpfel naïve\ncafé"] and cut[6] == []


def test_edges(spark):
    items = spark.createDataFrame(ITEMS + [(9, "of some words and a")], "item_id long, text string")
    df = decontaminate(edge_docs(spark), items, out="found")
    got = df.select("doc_id", "found.n_words", "found.n_hit", "fp").collect()
    assert len(got) == len(TEXTS) and all(r.fp == "own fp" for r in got)
    assert sorted(r.n_hit for r in got if r.doc_id in (1, 7)) == [5, 5, 5]
    assert {(r.n_words, r.n_hit) for r in got if r.doc_id in (2, 3, 4)} == {(0, 0)}
    assert [r.n_words for r in got if r.doc_id == 5] == [60_001]
    assert decontaminate(empty_docs(spark), items).count() == 0
    none = decontaminate(edge_docs(spark), items.where("item_id = -1"))
    assert none.where("contamination.contaminated").count() == 0 and none.count() == len(TEXTS)


LAPPED = "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16 w17 w18 w19 w20 w21 w22 w23"


@pytest.mark.parametrize("blocks", [{}, {"block_windows": 1}, {"block_windows": 4}, {"block_bytes": 100}, {"block_bytes": 1}])
def test_spans_do_not_depend_on_the_blocks(spark, blocks):
    """Windows of different blocks overlap, touch and come out of order in a text."""
    items = spark.createDataFrame([(1, LAPPED), (2, "w3 w4"), (3, "z1 z2 z3 z4 z5 z6 z7 z8 z9 z10 z11")], "item_id long, text string")
    text = "x " + LAPPED + " y w3 w4, z1 z2 z3 z4 z5 z6 z7 z8 z9 z10 z11 " + LAPPED[9:]
    docs = spark.createDataFrame([(1, text), (2, "a w3 w4 b"), (3, "nothing"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r.contamination for r in decontaminate(docs, items, **blocks).collect()}
    assert [text[s.start:s.end] for s in got[1].spans] == [
        LAPPED, "w3 w4, z1 z2 z3 z4 z5 z6 z7 z8 z9 z10 z11 " + LAPPED[9:]]
    assert got[1]["items"] == ["1", "2", "3"] and got[1].n_hit == 24 + 2 + 11 + 21
    assert [(got[i].full, got[i].contaminated) for i in (1, 2, 3, 4)] == [(True, True), (False, True), (False, False), (False, False)]


def test_blocks_by_bytes(spark):
    items = spark.createDataFrame([(i, " ".join(f"v{(i * 7 + j) % 997}" for j in range(30))) for i in range(200)],
                                  "item_id long, text string")
    blocks = list(_blocks(items, "item_id", "text", 10, 10**6, 10_000))
    sizes = [sum(len(w) + sum(map(len, ids)) for w, ids in b.items()) for b in blocks]
    assert len(blocks) > 5 and max(sizes) < 10_100
    whole, = _blocks(items, "item_id", "text", 10, 10**6, 10**9)
    joined: dict = {}
    for b in blocks:
        for w, ids in b.items():
            joined.setdefault(w, set()).update(ids)
    assert joined == whole
