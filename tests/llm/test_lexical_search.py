import math
import re
from collections import Counter

import numpy as np
import pytest

from paylens.llm import lexical_search as search

PATTERN = re.compile(search.TERM)


def terms(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc_id, c in counts:
            score = 0
            for t in wanted & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 10 + 90 * c.total() * n_docs // total
                score += w * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort(key=lambda s: s[:3])
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k=10):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id bigint, text string, term string, item bigint")
    q = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, score string")
    rows = search.search(d, q, k)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"] and dict(rows.dtypes)["rank"] == "int"
    return sorted(map(tuple, rows.collect()), key=str)


@pytest.fixture
def small(monkeypatch):
    """Many blocks and bundles from little data."""
    monkeypatch.setattr(search, "BLOCK_DOCS", 16)
    monkeypatch.setattr(search, "BUNDLE_ITEMS", 3)


def corpus(seed, n):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "ß", "日本", "K", "x1", "THE"]
    shares = 1 / np.arange(1, len(words) + 1)
    return [(i, " ".join(rng.choice(words, rng.integers(0, 60), p=shares / shares.sum()))) for i in range(n)]


def test_equals_scoring_every_document(spark, small):
    docs = corpus(1, 160) + [(900, None), (901, ""), (902, "w3 ... w4"), (903, "the the-THE_the w50 " * 5000), (None, "w59 w58 w57"),
                             (905, "w59 w58 w57"), (5, "w59 w1"), (5, "w59 w1"), (906, "\x00 w2\x7fw3")]
    items = [(i, " ".join(f"w{j}" for j in range(i, 60, 7))) for i in range(7)]
    items += [(20, "The THE é É"), (21, None), (22, "..."), (23, "unseen words"), (None, "w1 w2"), (24, "w57"), (24, "w58 w59"),
              (25, "w0 w1 w2 w3"), (26, "日本, x1")]
    assert found(spark, docs, items) == expected(docs, items)
    assert found(spark, docs, items, 3) == expected(docs, items, 3)


def test_ties_go_to_the_smallest_id(spark, small):
    docs = [(i, "same words here") for i in range(300, 0, -1)] + [(1000 + i, "other") for i in range(5)]
    items = [(1, "words"), (2, "other words"), (3, "here here here")]
    rows = found(spark, docs, items)
    assert rows == expected(docs, items)
    assert [r[2] for r in sorted(rows) if r[0] == 1] == list(range(1, 11))


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == [] == found(spark, [(1, "a")], []) == found(spark, [(1, None)], [(1, "a")])


def test_bounds_let_only_losers_go(spark, small):
    """Documents that rare terms open first must not hide one that wins by frequent terms."""
    docs = [(i, "rare " + "z " * 900) for i in range(12)] + [(100 + i, "common often usual") for i in range(60)]
    docs += [(500 + i, "filler") for i in range(40)]
    items = [(1, "rare common often usual")]
    assert found(spark, docs, items) == expected(docs, items)
