"""Scores of the classifiers against slow versions: one window, one trigram at a time."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest

from paylens.llm import compression_toxicity as toxicity
from paylens.llm import language_id as language
from paylens.llm.catalog import table

SF = "/root/testdata/sf0.001"
EDGES = ["", " ", "a", "idiot", "x" * 61, "x" * 62, "x" * 63, "x" * 64, "x" * 95, "é" * 40, "you are worthless, IDIOT!\n" * 30, "日本語のテキスト" * 20,
         "The cat is on the mat. " * 900, "\x00\x01", "12 34", "ß", "it's", "😀 ok", "le chat est sur la table et il mange", "àb"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = table(spark, SF, "documents").filter("text is not null").orderBy("doc_id").limit(60).collect()
    return EDGES + [r.text for r in rows]


def plain_toxicity(model, text):
    coded = toxicity.recoded([text.encode()])[0]
    differences = []
    for i in range(max(1, math.ceil((len(coded) - toxicity.WINDOW) / toxicity.STEP) + 1)):
        window = coded[i * toxicity.STEP:i * toxicity.STEP + toxicity.WINDOW]
        ordinary, toxic = (len(toxicity._compressor(d).compress(window)) for d in (model.ordinary, model.toxic))
        differences.append(ordinary - toxic)
    n = len(differences)
    shares = [sum(d >= t for d in differences) / n * (5 + 2.5 * i) for i, t in enumerate(toxicity.BYTES)]
    row = [min(sum(differences) / n, 2.0), *shares, min(max(differences), 12) / 6, 1.0]
    z = sum(a * b for a, b in zip(row, model.weights))
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def test_toxicity_is_one_compressor_call_per_window(spark, texts):
    model = toxicity.fit(table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels"))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "doc_id bigint, text string")
    found = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert found[-1] == found[0] and len(model.toxic) > len(toxicity._dictionary([b"x"], 8, 8, 16))
    for i, text in enumerate(texts):
        assert found[i] == pytest.approx(plain_toxicity(model, text), abs=1e-9), text[:40]
    assert found[EDGES.index(EDGES[10])] > 0.7


def plain_language(model, text):
    """Every machine over every trigram of letters, then votes in the family and inside it."""
    if not re.search(r"[^\W\d_]", text):
        return language.UNDETERMINED, 0.0
    raw = np.frombuffer(text.encode(), np.uint8)
    buckets = language.trigram_buckets(raw, np.array([0, len(raw)])).tolist()
    seen = max(1, sum(b > 0 for b in buckets))
    chance = {}
    for key, weights in model.machines.items():
        margin = sum(weights[b] for b in buckets) / math.sqrt(seen)
        chance[key] = 1 / (1 + math.exp(-max(-30, min(30, 4 * margin))))

    def winner(group, names):
        best = None
        for name in names:
            won, total, least = 0, 0.0, 1.0
            for (g, a, b), p in chance.items():
                if g == group and name in (a, b):
                    q = p if name == a else 1 - p
                    won += p >= 0.5 if name == a else p < 0.5
                    total, least = total + q, min(least, q)
            if best is None or won * (len(names) + 1) + total > best[0]:
                best = won * (len(names) + 1) + total, name, least
        return best[1:]

    members = model.members()
    family, p = winner("*", sorted(members))
    name, q = winner(family, members[family])
    return name, p * q


def test_language_is_a_plain_vote_of_machines(spark, texts):
    model = language.fit(table(spark, "/root/testdata/sf0.01", "documents"))
    names, scores = language.predict_texts(model, pa.array(texts))
    for text, name, score in zip(texts, names, scores):
        want, p = plain_language(model, text)
        assert (name, score) == (want, pytest.approx(p, abs=1e-9)), text[:40]
    assert len(set(names)) == 5
