import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from candlewick.llm import queries as Q
from candlewick.llm.fill_middle import SkipList, check_sentinels, fill_in_middle, rebuilt, restore, transformed
from tests.llm.helpers import LONG, TEXTS, edge_docs, empty_docs, rows

MIXED = "aé日😀\x00 <\n"


def brute(doc_id, text):
    """The contract, on a Python string."""
    t = text or ""
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i:8 * i + 8], 16) for i in range(4)]
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(t), "plain", None, None, t
    a, b = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    if h[3] % 100 < 20:
        return len(t), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return len(t), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def some_texts(n=200, longest=700):
    r = random.Random(3)
    return ["".join(r.choice(MIXED) for _ in range(r.randrange(longest))) for _ in range(n)]


@pytest.mark.parametrize("fan,piece", [(2, 7), (3, 64), (64, 1 << 18)])
def test_descent_reaches_every_rank(fan, piece):
    for text in some_texts(20, 200):
        units = SkipList(text.encode(), None, fan, piece)
        assert units.total == (len(text), len(text), len(text.encode()))
        for rank in range(len(text) + 1):
            assert units.descend(rank) == (rank, len(text[:rank].encode()))
        with pytest.raises(IndexError):
            units.descend(len(text) + 1)


def test_units_of_a_pattern():
    pattern = re.compile(r"\w+|\s+")
    for text in some_texts(20, 200):
        units, at = [], 0
        for m in pattern.finditer(text):
            units += [*text[at:m.start()], m[0]]
            at = m.end()
        units += text[at:]
        found = SkipList(text.encode(), pattern, 3, 64)
        assert found.total[0] == len(units)
        for rank in range(len(units) + 1):
            head = "".join(units[:rank])
            assert found.descend(rank) == (len(head), len(head.encode()))


def test_lanes_are_smaller_than_a_long_text():
    raw = ("日本語 text " * 50_000).encode()
    assert sum(lane.nbytes for lane in SkipList(raw).lanes) < len(raw) / 2


def test_matches_brute_force(spark):
    texts = [(i, t) for i, t in enumerate(some_texts())] + [(900, "a<P>b"), (901, "<S"), (902, "<"), (903, LONG * 3)]
    df = fill_in_middle(spark.createDataFrame(texts, "doc_id long, text string")).select("doc_id", "fim.*")
    got = {r[0]: tuple(r)[1:] for r in df.collect()}
    assert got == {i: brute(i, t) for i, t in texts}
    forms = {r[1] for r in got.values()}
    assert forms == {"plain", "psm", "spm"}


def test_edges_and_round_trip(spark):
    df = restore(fill_in_middle(edge_docs(spark)).withColumn("o", F.col("fim")["output"]), F.col("o"), F.col("fim")["form"])
    got = rows(df, "doc_id", "text", "restored", "fim.n", "score")
    assert len(got) == len(TEXTS)
    assert all(r == (t or "") and n == len(t or "") and own == "own score" for _, t, r, n, own in got)
    expected = sorted(((i, t, *brute(i, t)) for i, t in TEXTS), key=str)
    assert sorted(rows(df, "doc_id", "text", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", "fim.output"),
                  key=str) == expected
    assert fill_in_middle(empty_docs(spark)).count() == 0


def test_sentinels_can_not_arise_at_a_joint():
    check_sentinels(("<P>", "<S>", "<M>"))
    for bad in (("", "b", "c"), ("a", "a", "b"), ("aba", "x", "y"), ("ab", "ba", "x"), ("abc", "b", "x")):
        with pytest.raises(ValueError):
            check_sentinels(bad)
    r = random.Random(5)
    for _ in range(2000):
        text = "".join(r.choice("<PSM>") for _ in range(r.randrange(12)))
        got = transformed(text, tuple(r.randrange(1 << 32) for _ in range(4)))
        assert rebuilt(got["output"], got["form"]) == text


def test_query_columns(spark):
    got = Q.op11_fill_middle(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = {d.doc_id: (*(x := brute(d.doc_id, d.text))[:4], sha(x[4]), sha(d.text or "")) for d in docs}
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == expected
