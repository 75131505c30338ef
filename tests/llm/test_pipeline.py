import numpy as np
import pyarrow as pa

import corpus_pipeline
from paylens.llm import compression_toxicity, curve_packing, language_id, pii_spans
from paylens.llm.catalog import table, tokenizer_path
from paylens.llm.scratch import Scratch
from test_circulant_minhash import brute_components, brute_sets  # same folder

SF = "/root/testdata/sf0.01"
ADDED = [(-1, None, None, "s", 0), (-2, "", "en", "s", 0), (-3, "12 %%% ...", "en", "s", 3),
         (-4, "call +49 30 1234567 or mail me@example.org, the cat is on the mat and the dog is in the house", "en", "s", 5)]


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    docs = docs.unionByName(spark.createDataFrame(ADDED, docs.schema))
    labels = table(spark, SF, "labels")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "toxicity", "near_dedup", "personal_data", "packing"]
    scratch = Scratch(spark, "test")
    states = [{r.doc_id: tuple(r) for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        given = docs
        docs = scratch.settle(stage(spark, docs, SF), name)
        if name != "packing":
            assert docs.schema.names == given.schema.names and docs.dtypes == given.dtypes
            rows = docs.collect()
            states.append({r.doc_id: tuple(r) for r in rows})
            assert len(rows) == len(states[-1])
        if name == "language":
            model = language_id.fit(given)
            texts = pa.array([r[1] for r in states[0].values()], pa.string())
            lang, score = language_id.predict_texts(model, texts)
            keep = {i for i, x, s in zip(states[0], lang, score) if x != "und" and s >= language_id.LEAST_SCORE}
            assert set(states[1]) == keep and not keep & {-1, -2, -3} and -4 in keep
            assert len(keep) > 0.98 * len(states[0])
        elif name == "toxicity":
            model = compression_toxicity.fit(given, labels)
            features = compression_toxicity.Features(model)
            x = features(compression_toxicity.recoded([r[1].encode() for r in states[1].values()]))
            chance = compression_toxicity._chance(x, np.array(model.weights))
            assert set(states[2]) == {i for i, p in zip(states[1], chance) if p < compression_toxicity.THRESHOLD}
        elif name == "near_dedup":
            ids = list(states[2])
            roots = brute_components(ids, brute_sets([states[2][i][1] for i in ids], 5))
            assert set(states[3]) == {i for i in ids if roots[i] == i}
            assert all(states[3][i] == states[2][i] for i in states[3])
        elif name == "personal_data":
            assert set(states[4]) == set(states[3])
            for i, before in states[3].items():
                text = pii_spans.masked(before[1], pii_spans.spans_of(before[1]))
                assert states[4][i] == (before[0], text, before[2], before[3], len(text))
            assert states[4][-4][1].startswith("call <PHONE> or mail <EMAIL>, ")
    pieces = docs.collect()
    assert {r.doc_id for r in pieces} == set(states[4])
    known = curve_packing.WordIds(tokenizer_path())
    total = {}
    for r in pieces:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    for i, row in list(states[4].items())[:60]:
        words = row[1].encode().lower().split()
        known.learn(set(words))
        assert total[i] == sum(len(known[w]) // 2 for w in words) + 1
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == docs.columns and rows.count() > 500


def test_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
