import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from candlewick.llm.components import components
from candlewick.llm.queries import op9_simhash
from candlewick.llm.simhash import fingerprint, hex16, keep_one, links, near_duplicates
from tests.conftest import SF001
from tests.llm.helpers import LONG, TEXTS, edge_docs, empty_docs


def brute_print(text, n=3):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[k:k + n]) for k in range(max(1, len(w) - n + 1))] if w else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_classes(prints, bits=3):
    """{id: smallest id reachable}; prints: [(id, fingerprint)]."""
    parent = list(range(len(prints)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= bits:
                parent[find(a)] = find(b)
    low = {}
    for a, (i, _) in enumerate(prints):
        r = find(a)
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return [low.get(find(a)) for a in range(len(prints))]


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    prints = [(i, brute_print(t)) for i, t in docs]
    exp = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_classes(prints))]
    assert sorted(tuple(r) for r in op9_simhash(spark, SF001).collect()) == sorted(exp)


@pytest.mark.parametrize("text", ["", " \n ", "a", "a b", "A b C", "é Ü ü  x\ty z" * 7, LONG])
def test_fingerprint(text):
    assert fingerprint(text) & (1 << 64) - 1 == brute_print(text)


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4, 6])
def test_links_of_clustered_fingerprints(spark, bits):
    rng = np.random.default_rng(bits)
    prints = {0, (1 << 64) - 1, 1, 3, 7, 15}
    for base in rng.integers(0, 1 << 63, 12, dtype=np.uint64):
        for _ in range(25):
            p = int(base)
            for b in rng.integers(0, 64, int(rng.integers(0, bits + 3))):
                p ^= 1 << int(b)
            prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {frozenset(tuple(r)) for r in links(df, bits).collect()}
    exp = {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= bits}
    assert got == exp


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    ring = [(i, 700 + (i - 699) % 9) for i in range(700, 709)]
    df = spark.createDataFrame(chain + star + ring + [(5, 3), (3, 5), (9, 9)], "a long, b long")
    got = {r.node: r.root for r in components(df, "a", "b").collect()}
    exp = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)} | {i: 700 for i in range(700, 709)} | {3: 3, 5: 3}
    assert got == exp
    assert components(df.where("a < 0"), "a", "b").count() == 0


def test_edges_and_keeping_one(spark):
    docs = edge_docs(spark)
    prints = [(i, brute_print(t)) for i, t in TEXTS]
    exp = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_classes(prints))]
    got = near_duplicates(docs).select("doc_id", hex16(F.col("fingerprint")), "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(exp, key=key)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(zip([p for _, p in prints], brute_classes(prints)))) or len(ids) == len(set(brute_classes(prints)))
    assert sorted(i for i in ids if i is not None) == sorted({c for c in brute_classes(prints) if c is not None})
    assert near_duplicates(empty_docs(spark)).count() == 0 and keep_one(empty_docs(spark)).count() == 0


def test_classes_without_ids_keep_one_each(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "other words here"), (None, None), (4, "")],
                               "doc_id long, text string")
    kept = keep_one(df).collect()
    assert sorted((r.doc_id is None, r.text or "") for r in kept) == [(False, ""), (True, "a b c d"), (True, "other words here")]


def test_of_repeated_ids_the_same_row_stays(spark):
    """Whatever the partitions; a row that is there twice stays once."""
    near = [(1, "a b c d e f g h i j"), (1, "a b c d e f g h i j"), (1, "A B C d e f g h i j"), (2, "a b c d e f g h i j"),
            (1, "entirely other words are here"), (None, "a b c d e f g h i j")]
    kept = set()
    for parts in (1, 3, 6):
        for rows in (near, near[::-1]):
            df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
            kept.add(tuple(sorted(map(tuple, keep_one(df).collect()))))
    assert len(kept) == 1
    only, = kept
    assert [r[0] for r in only] == [1, 1] and only[1][1] == "entirely other words are here"


def test_keeping_one_reads_texts_once(spark):
    """The texts are written with their fingerprints; no window, and one Python stage over them."""
    df = keep_one(edge_docs(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "ArrowEvalPython" not in plan
