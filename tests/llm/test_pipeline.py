import corpus_pipeline
from candlewick.llm.common import written
from tests.conftest import SF001, SF01
from tests.llm.helpers import edge_docs, empty_docs
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_simhash import brute_classes, brute_print


def test_stages_act_on_all_their_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = written(stage(spark, docs, SF01), f"test-{name}")
        seen[name] = before, {r.doc_id: r for r in docs.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert all(before[i] == r for i, r in seen[name][1].items())
    before, after = seen["quality"]
    good = [i for i in before if i in labels and labels[i].quality == 1]
    junk = [i for i in before if i in labels and labels[i].quality == 0]
    assert sum(i in after for i in good) > 0.98 * len(good) and sum(i in after for i in junk) < 0.2 * len(junk)
    before, after = seen["toxicity"]
    clean = [i for i in before if i in labels and labels[i].toxic == 0]
    toxic = [i for i in before if i in labels and labels[i].toxic == 1]
    assert sum(i in after for i in clean) > 0.98 * len(clean) and sum(i in after for i in toxic) < 0.5 * len(toxic)
    before, after = seen["simhash"]
    prints = [(i, brute_print(r.text)) for i, r in sorted(before.items())]
    assert set(after) == set(brute_classes(prints))
    before, after = seen["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    bad = {r[0] for r in contaminated([(i, r.text) for i, r in before.items()], items) if r[-1]}
    assert bad and set(after) == set(before) - bad
    before, after = seen["sentencepiece"]
    assert set(after) == set(before) and all(r.parity and r.round_trip and r.n_tokens == len(r.ids) for r in after.values())


def test_edges_and_empty_tables(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        n = docs.count()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, docs, SF001)
            assert got.columns == docs.columns and got.count() <= n
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
        assert last.count() == n and len(last.columns) == len(set(last.columns))
        assert set(docs.columns) <= set(last.columns)
