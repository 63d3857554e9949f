import corpus_pipeline
from chatterscope.llm import jaccard, pii, quality, registry
from chatterscope.llm.common import table
from chatterscope.llm.sentencepiece import cut, decode, load_vocabulary

import test_decontamination
import test_jaccard

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    weights, transition = quality.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    kept = {}
    for i, t in docs.items():
        sizes, x = quality.line_features(t)
        states = quality.viterbi(x @ weights, transition)
        share = sum(n for n, s in zip(sizes, states) if s) / max(1, sum(sizes))
        if not quality.counts(t)[5] and share >= quality.CONTENT_SHARE:
            kept[i] = t
    kept = {i: kept[i] for i, _, root, _ in test_jaccard.brute(list(kept.items())) if root == i}
    kept = {r[0]: kept[r[0]] for r in test_decontamination.brute(list(kept.items()), items, 10) if not r[5]}
    anchors = pii.automaton()
    kept = {i: pii.mask(t, pii.find(t, anchors)) for i, t in kept.items()}
    rows = corpus_pipeline.run(spark, SF).collect()
    vocab = load_vocabulary(corpus_pipeline.VOCABULARY)
    assert {r.doc_id: r.text for r in rows} == kept and kept
    assert all(decode(__import__("numpy").array(r.ids), vocab) == r.text and cut(r.text) for r in rows)


def test_every_operator_has_a_query():
    queries, sql = registry.load()
    assert sorted(int(q[2:].split("_")[0]) for q in queries) == list(range(1, 11)) and set(sql) <= set(queries)
    assert jaccard.PERCENT == 80 and [n for n, _ in corpus_pipeline.STAGES][1] == "jaccard_join"
