import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from paylens.llm import column_suffixes as suffixes


def sorted_suffixes(members):
    """(suffix, member) of all suffixes, ends told apart by the order of members."""
    rank = {m: i for i, m in enumerate(np.argsort([-len(m) for m in members], kind="stable").tolist())}
    rows = [(members[m][i:], rank[m], m, i) for m in range(len(members)) for i in range(len(members[m]) + 1)]
    return sorted(rows, key=lambda r: ([(b, 0) for b in r[0]] + [(-1, r[1])]))


def shared(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=12).map(lambda b: bytes(c % 3 if c < 250 else 255 for c in b)), min_size=1, max_size=12))
def test_transform_and_common_prefixes_equal_sorting(members):
    built = suffixes.Collection(members)
    rows = sorted_suffixes(members)
    assert [int(s) for s in built.symbols] == [members[m][i - 1] + 1 if i else 0 for _, _, m, i in rows]
    assert built.common.tolist() == [0] + [shared(a[0], b[0]) for a, b in zip(rows, rows[1:])]


def test_smallest_documents_of_windows():
    rng = np.random.default_rng(3)
    members = list({bytes(rng.integers(97, 99, rng.integers(0, 30)).tolist()) for _ in range(300)})
    documents = rng.integers(-50, 50, len(members))
    least = {}
    for m, d in zip(members, documents.tolist()):
        for i in range(len(m) - 7):
            least[m[i:i + 8]] = min(d, least.get(m[i:i + 8], d))
    for m, found in zip(members, suffixes.smallest_documents(members, documents, 8)):
        assert found.tolist() == [least[m[i:i + 8]] for i in range(len(m) - 7)]


def expected(rows, length=50):
    least = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        if i is not None:
            for at in range(len(b) - length + 1):
                w = b[at:at + length]
                least[w] = min(i, least.get(w, i))
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, bool)
        if i is not None:
            for at in range(len(b) - length + 1):
                if least[b[at:at + length]] < i:
                    gone[at:at + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone[:-1], [0]]).astype(int)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((i, len(b), spans, bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])))
    return sorted(out, key=str)


def found(spark, rows, length=50, limits=suffixes.Limits()):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, bundle string, bucket int")
    done = suffixes.remove_repeats(docs.repartition(3), length, limits)
    got = [(r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in done.collect()]
    digest = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.digests(done).collect()}
    assert digest == {(i, n, n - len(k), len(s), hashlib.sha256(k).hexdigest()) for i, n, s, k in got}
    return sorted(got, key=str)


def corpus():
    rng = np.random.default_rng(5)
    words = ["on", "the", "été", "日本", "tion", "a", "\n", "😀", "stone"]

    def prose(n):
        return " ".join(rng.choice(words, n))

    passages = [prose(n) for n in (9, 14, 20, 60, 200)]
    rows = []
    for i in range(160):
        parts = [prose(rng.integers(0, 40))]
        for _ in range(rng.integers(0, 4)):
            parts += [passages[rng.integers(len(passages))], prose(rng.integers(0, 12))]
        rows.append((int(rng.integers(-300, 300)), "".join(parts)))
    rows += [(400 + i, rows[i][1]) for i in range(10)]
    rows += [(500, None), (501, ""), (502, "x" * 49), (503, "x" * 50), (504, "x" * 3000), (505, "ab" * 900), (506, "ba" * 900),
             (None, rows[0][1]), (None, passages[4]), (-301, "x" * 51), (507, "y" * 50), (507, "y" * 50), (508, "y" * 50),
             (509, passages[4] * 40), (500, None)]
    return rows


def test_equals_a_set_of_all_windows(spark):
    rows = corpus()
    assert found(spark, rows) == expected(rows)


def test_hot_keys_many_bundles_and_buckets(spark):
    rows = corpus()
    limits = suffixes.Limits(hot=3, bundle=3000, key_bucket=20_000, piece_bucket=5_000, collection=900)
    assert found(spark, rows, limits=limits) == expected(rows)
    assert found(spark, rows[:80], 30, limits) == expected(rows[:80], 30)


def test_empty_and_short(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, "short")]) == [(1, 0, [], b""), (2, 5, [], b"short")]


@pytest.mark.parametrize("length, chunk", [(20, 1 << 20), (64, 1 << 20), (50, 700)])
def test_every_window_lies_in_one_piece(monkeypatch, length, chunk):
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", chunk)
    raw = np.frombuffer(("some words and " * 300 + "x" * 500).encode(), np.uint8)
    at = np.array([0, 10, 10, 2000, 2000 + length, len(raw)])
    starts, counts, _ = suffixes.windows(raw, at, np.array([True, True, True, True, False]), length)
    have = np.concatenate([np.arange(s, s + c) for s, c in zip(starts, counts)])
    assert have.tolist() == [i for b, e in zip(at[:4], at[1:5]) for i in range(b, e - length + 1)]
    assert counts.max(initial=0) <= length - min(suffixes.GRAM, length) + 1
