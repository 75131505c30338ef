"""Toxicity, language and quality: learnt on part of the driver's tables, measured on the rest."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paylens.llm import compression_toxicity as toxicity
from paylens.llm import language_id as language
from paylens.llm import target_quality as quality
from paylens.llm.catalog import table

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF, "labels")


EDGE_ROWS = [(1, None, None, "x"), (2, "", "en", "x"), (3, " \n ", None, "x"), (4, "123 %%% 5", "en", "x"),
             (5, "a", None, "x"), (None, "the cat and the dog", "en", "x"), (5, "a", None, "x"),
             (6, "word " * 60_000, None, "x")]
EDGE_SCHEMA = "doc_id bigint, text string, lang string, score string"


def test_toxicity_on_held_out_documents(spark, docs, labels):
    model = toxicity.fit(docs, labels)
    found = (toxicity.score(docs, model).filter("held_out")
             .join(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id").collect())
    toxic = [r.predicted for r in found if r.toxic == 1]
    ordinary = [r.predicted for r in found if r.toxic == 0]
    assert len(toxic) > 50 and np.mean(toxic) > 0.8 and np.mean(ordinary) < 0.04
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    edges = spark.createDataFrame(EDGE_ROWS, EDGE_SCHEMA)
    scored = toxicity.score(edges, model).collect()
    assert len(scored) == len(EDGE_ROWS) and all(r.predicted == 0 for r in scored)
    assert len({r.score for r in scored if r.doc_id in (1, 2)}) == 1
    kept = toxicity.without_toxic(edges, model)
    assert kept.columns == edges.columns and kept.count() == len(EDGE_ROWS)
    insult = spark.createDataFrame([(9, "you worthless stupid idiot, you pathetic clown " * 3, None, "x")], EDGE_SCHEMA)
    assert toxicity.without_toxic(insult, model).count() == 0


def test_toxicity_without_labels(spark, labels):
    edges = spark.createDataFrame(EDGE_ROWS, EDGE_SCHEMA)
    model = toxicity.fit(edges, labels.limit(0))
    assert model is None and {r.score for r in toxicity.score(edges, model).collect()} == {0.0}
    assert toxicity.without_toxic(edges, model).count() == len(EDGE_ROWS)
    assert toxicity.score(edges.limit(0), model).count() == 0
    tiny = toxicity.train([("you idiot", 1), ("good day", 0)])
    assert tiny is not None and len(tiny.weights) == 6


def test_windows_cover_each_text_alone():
    model = toxicity.train([("a total idiot spoke " * 9, 1)] * 6 + [("the calm sea was wide and deep " * 9, 0)] * 6)
    features = toxicity.Features(model)
    texts = toxicity.recoded([t.encode() for t in ("", "idiot", "the sea " * 100, "x" * 47, "idiot " * 5000)])
    together = features(texts)
    for text, row in zip(texts, together):
        assert np.allclose(features([text])[0], row)


def test_language_on_held_out_documents(spark, docs):
    model = language.fit(docs)
    assert model.languages == ["de", "en", "es", "fr"]
    assert set(model.machines) == {("*", "germanic", "romance"), ("germanic", "de", "en"), ("romance", "es", "fr")}
    found = language.predict(docs, model).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) > 1000 and np.mean([r.lang == r.lang_pred for r in found]) > 0.98
    edges = spark.createDataFrame(EDGE_ROWS, EDGE_SCHEMA)
    by_id = {r.doc_id: r for r in language.predict(edges, model).collect()}
    assert [by_id[i].lang_pred for i in (1, 2, 3, 4)] == ["und"] * 4 and by_id[1].score == 0
    assert by_id[5].lang_pred != "und" and by_id[None].lang_pred == "en" and by_id[None].held_out is False
    assert language.accepted(edges, model).columns == edges.columns
    share = language.accepted(docs, model).count() / docs.count()
    assert share > 0.98


def test_language_with_few_or_no_classes(spark):
    edges = spark.createDataFrame(EDGE_ROWS, EDGE_SCHEMA)
    none = language.fit(edges.filter("lang is null"))
    assert {r.lang_pred for r in language.predict(edges, none).collect()} == {"und"}
    one = language.fit(spark.createDataFrame([(i, "hello there", "en", "x") for i in range(9)], EDGE_SCHEMA))
    assert {r.lang_pred for r in language.predict(edges, one).collect()} == {"und", "en"}
    assert language.predict(edges.limit(0), one).count() == 0


def test_trigrams_do_not_cross_texts():
    texts = pa.array(["abc", "", "é", None, "xy", "a"])
    raw, at = language.text_bytes(texts)
    together = language.trigram_buckets(raw, at)
    for text, begin, end in zip(texts.to_pylist(), at[:-1], at[1:]):
        alone = language.trigram_buckets(*language.text_bytes(pa.array([text])))
        assert together[begin:end].tolist() == alone.tolist()


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), failed)


def test_quality_base_rules(spark):
    rng = np.random.default_rng(6)
    parts = ["a", "bb", "é", "#x|", "\n", "\n\n", " ", "\t", "a b c\n", "x\x1cy", " "]
    rows = [(i, "".join(f"{w} " if rng.random() < 0.7 else w for w in rng.choice(parts, rng.integers(0, 120))), "en", "x")
            for i in range(300)] + [(400, None, None, "x"), (401, "", None, "x"), (None, "a b c " * 30, None, "x"),
                                    (402, "w " * 100_000, None, "x"), (402, "w " * 100_000, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, kept string")
    ratios = quality.log_ratios(docs, docs.filter("doc_id < 100"))
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality.judge(docs, ratios).collect())
    assert got == Counter((r[0], *brute_base(r[1])) for r in rows)
    assert quality.judge(docs.limit(0), ratios).count() == 0


def test_quality_ratio_is_the_mean_over_grams(spark):
    rows = [(1, "good words here", "x"), (2, "bad !!!! ####", "x"), (3, "abc", "x"), (4, None, "x"), (None, "good", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    trusted = spark.createDataFrame([(1,), (1,), (None,)], "doc_id bigint")
    ratios = quality.log_ratios(docs, trusted)
    counts = np.zeros((2, quality.BUCKETS))
    for i, text, _ in rows:
        grams = quality.gram_buckets(np.frombuffer((text or "").encode(), np.uint8))
        np.add.at(counts[0], grams, 1)
        if i == 1:
            np.add.at(counts[1], grams, 1)
    share = (counts + 1) / (counts.sum(axis=1, keepdims=True) + quality.BUCKETS)
    assert np.allclose(ratios, np.log(share[1] / share[0]))
    by_id = {r.doc_id: r.score for r in quality.judge(docs, ratios).collect()}
    for i, text, _ in rows:
        grams = quality.gram_buckets(np.frombuffer((text or "").encode(), np.uint8))
        assert by_id[i] == pytest.approx(ratios[grams].mean() if len(grams) else 0.0)
    assert not quality.log_ratios(docs, trusted.limit(0)).any()


def test_quality_tells_trusted_from_junk(spark, docs, labels):
    judged = quality.judge(docs, quality.log_ratios(docs, labels.filter("quality = 1")))
    rows = judged.join(labels, "doc_id").filter("not base_failed").collect()
    assert np.mean([r.kept for r in rows if r.quality == 1]) > 0.99
    assert np.mean([r.kept for r in rows if r.quality == 0]) < 0.1


def test_recoding_is_reversible_and_tied_to_places():
    texts = [b"Ab abab\nab", b"", "é-x".encode(), b"z" * 40]
    for text, coded in zip(texts, toxicity.recoded(texts)):
        back, place = bytearray(), 0
        for byte in coded:
            plain = next(b for b in range(256) if toxicity._RECODED[min(place, toxicity.PLACES - 1)][b] == byte)
            place = 0 if toxicity._NO_LETTER[plain] else place + 1
            back.append(plain)
        assert bytes(back) == b" " + text.lower() + b" "
    first = toxicity.recoded([b"ab abab"])[0]
    assert first[1:3] == first[4:6] != first[6:8]
