import random

import pytest

from candlewick.llm import queries as Q
from candlewick.llm.license_scan import (NOTICES, PHRASES, Automaton, Scanner, _Chains, pieces, scan, scan_licenses,
                                         statistics, words_of)
from tests.llm.helpers import TEXTS, edge_docs, empty_docs, rows

STANDARD = Scanner(NOTICES, PHRASES, 4, 12, 0.8)


def small(seed):
    r = random.Random(seed)
    word = lambda: r.choice("abc")
    notices = [(f"n{i}", " ".join(word() for _ in range(r.randrange(1, 9)))) for i in range(5)]
    phrases = {" ".join(word() for _ in range(r.randrange(1, 4))): f"p{i}" for i in range(3)}
    return notices, phrases, " ".join(r.choice("abcd") for _ in range(r.randrange(60)))


def occurs(part, whole):
    return any(whole[i:i + len(part)] == part for i in range(len(whole) - len(part) + 1))


@pytest.mark.parametrize("seed", range(60))
def test_matching_statistics(seed):
    notices, phrases, text = small(seed)
    s = Scanner(notices, phrases, 2, 3, 0.8)
    templates, words = s.automaton.templates, words_of(text)
    got = {at: (state, run) for at, state, run, _ in statistics(s, text.encode()) if state >= 0}
    for i in range(len(words)):
        run = max((n for n in range(i + 2) if any(occurs(words[i + 1 - n:i + 1], t) for t in templates)), default=0)
        assert got.get(i, (0, 0))[1] == run
        if run:  # the ends below the state are those of the run in the templates
            ends = {(t, e) for t, w in enumerate(templates) for e in range(len(w))
                    if e + 1 >= run and w[e + 1 - run:e + 1] == words[i + 1 - run:i + 1]}
            assert set(s.automaton.ends_below(got[i][0])) == ends


@pytest.mark.parametrize("seed", range(60))
def test_phrases_and_best_share(seed):
    notices, phrases, text = small(seed)
    s, words = Scanner(notices, phrases, 2, 3, 2.0), words_of(text)  # no chain is closed for being complete
    places = [(i, label) for p, label in phrases.items() for i in range(len(words))
              if words[i:i + len(words_of(p))] == words_of(p)]
    got = scan(s, text)
    assert (got["n_words"], got["n_base"]) == (len(words), len(places))
    assert got["first_word"] == min((i for i, _ in places), default=None)
    assert got["last_word"] == max((i for i, _ in places), default=None)
    assert got["base_labels"] == sorted({x for _, x in places})
    share = 1.0 if places else 0.0
    for _, notice in notices:
        t = words_of(notice)
        least, best = min(2, len(t)), {}
        found = sorted((e, te, n) for e in range(len(words)) for te in range(len(t)) for n in [common(words, t, e, te)]
                       if n >= least and (te + 1 == len(t) or e + 1 == len(words) or words[e + 1] != t[te + 1]))
        for e, te, n in found:
            best[e, te] = max([n] + [c + n - max(0, te2 - te + n, e2 - e + n) for (e2, te2), c in best.items()
                                     if e2 < e and te2 < te and e - n - e2 <= 3])
        share = max([share] + [c / len(t) for c in best.values()])
    assert got["score"] == share


def common(words, t, e, te):
    n = 0
    while n <= min(e, te) and words[e - n] == t[te - n]:
        n += 1
    return n


def test_notices_are_found():
    for label, text in NOTICES:
        noisy = f"# some code here\n{text.upper()}\nmore of it".replace(", ", ",\n * ")
        got = scan(STANDARD, noisy)
        assert label in got["labels"] and got["score"] == 1.0, (label, got)
    got = scan(STANDARD, "Licensed under CC BY-NC 4.0.")
    assert got["labels"] == ["cc-by", "cc-by-nc"] and got["base_labels"] == ["cc-by"]
    share = scan(STANDARD, NOTICES[[x for x, _ in NOTICES].index("cc-by-sa") + 1][1])
    assert share["labels"] == ["cc-by-sa"]
    # changed words and a cut leave a covered span, unrelated words none
    mit = next(t for x, t in NOTICES if x == "mit" and len(t) > 200)
    changed = mit.replace("person", "individual").replace("including without limitation", "including")
    assert scan(STANDARD, changed)["labels"] == ["mit"]
    assert scan(STANDARD, mit[:len(mit) // 3])["labels"] == []
    assert scan(STANDARD, "the rights of the reserved version of all software and the work is done")["labels"] == []


def test_copies_are_spans_of_their_own():
    line = "Released under the MIT License. "
    got = scan(STANDARD, line * 3 + "x " * 50 + line)
    assert [(x["first"], x["last"]) for x in got["spans"]] == [(0, 4), (5, 9), (10, 14), (65, 69)]


def test_chain_keeps_no_old_matches():
    c = _Chains(6, 3, 0.8)
    for end in range(2, 5000, 3):
        c.add(2, end, 3)
        assert len(c.open) < 8


def test_pieces_cut_no_word():
    raw = ("Wörd\x01日本 " * 300 + "x" * 5000 + " End").encode()
    for size in (1, 7, 100, 1 << 20):
        cut = list(pieces(raw, size))
        assert b"".join(cut) == raw.lower()
        assert [w for p in cut for w in words_of(p)] == words_of(raw)


def test_automaton_is_linear_in_the_templates():
    r = random.Random(4)
    templates = [[b"%d" % r.randrange(9) for _ in range(300)] for _ in range(20)]
    assert len(Automaton(templates + templates).next) <= 2 * 20 * 300


def test_edges(spark):
    got = rows(scan_licenses(edge_docs(spark)), "doc_id", "text", "license.n_words", "license.labels", "license.score",
               "score")
    assert len(got) == len(TEXTS)
    for _, text, n, labels, score, own in got:
        assert (n, labels, score, own) == (len(words_of(text)), [], 0.0, "own score")
    assert scan_licenses(empty_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        scan_licenses(edge_docs(spark), notices=[("x", "word " * 200_001)])
    assert scan_licenses(edge_docs(spark), notices=[("x", ".")], phrases={}).count() == len(TEXTS)


def test_query(spark):
    got = Q.op13_license_scan(spark, "/root/testdata/sf0.001").collect()
    docs = {d.doc_id: words_of(d.text) for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(got) == len(docs)
    for r in got:
        w = docs[r.doc_id]
        places = [(i, x) for p, x in PHRASES.items() for i in range(len(w)) if w[i:i + len(words_of(p))] == words_of(p)]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == (min((i for i, _ in places), default=None),
                                               max((i for i, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
