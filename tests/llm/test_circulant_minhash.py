import re

import numpy as np
import pyarrow as pa

from paylens.llm import circulant_minhash as cm
from paylens.llm.components import connected_components
from paylens.llm.scratch import Scratch


def brute_sets(texts, size):
    sets = []
    for text in texts:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        grams = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    return sets


def brute_components(ids, sets, percent=80):
    root = {i: i for i in ids if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in zip(ids, sets):
        for j, b in zip(ids, sets):
            if i is None or j is None or not a or not b or i >= j:
                continue
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def check(spark, rows, size):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_shingles string")
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept)
           for r in cm.near_duplicates(docs, size, 80).collect()}
    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    sets = brute_sets(texts, size)
    roots = brute_components(ids, sets)
    assert got == {(i, len(s), roots.get(i), i is None or roots[i] == i) for i, s in zip(ids, sets)}


def test_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, base = [], [" ".join(rng.choice(vocabulary, n)) for n in (3, 12, 40, 60, 200, 900)]
    for n in range(160):
        words = base[rng.integers(len(base))].split()
        for _ in range(rng.integers(0, 1 + len(words) // 12)):
            words[rng.integers(len(words))] = rng.choice(vocabulary)
        rows.append((n * 7 % 401, " ".join(words), "x"))
    rows += [(900, None, None), (901, "", "x"), (902, " \t\n ", "x"), (903, "One", "x"), (904, "one ", "x"),
             (None, base[2], "x"), (905, base[2].upper(), "x"), (905, base[2].upper(), "x"),
             (906, "é " * 5000 + base[4], "x"), (907, " a  a", "x")]
    check(spark, rows, 2)
    check(spark, rows, 5)


def test_empty_table(spark):
    check(spark, [], 5)
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert cm.deduplicate(docs).columns == docs.columns and cm.deduplicate(docs).count() == 0


def test_one_stays_of_each_group_with_its_columns(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame(
        [(4, text, "a"), (2, text, "b"), (2, text, "b"), (9, None, "c"), (None, text, "d"), (7, "w1 w2", "e")],
        "doc_id bigint, text string, component_id string")
    kept = {tuple(r) for r in cm.deduplicate(docs).collect()}
    assert kept == {(2, text, "b"), (9, None, "c"), (None, text, "d"), (7, "w1 w2", "e")}


def test_signature_comes_from_two_permutations():
    members = np.arange(1, 50, dtype=np.uint64) * np.uint64(977)
    least = cm.signature(members)
    sigma = (cm.mix64(members ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
    for k in (0, 1, 77):
        assert least[k] == cm._permute(sigma + np.uint32(k)).min()
    assert len(set(cm._permute(np.arange(70000, dtype=np.uint32)).tolist())) == 70000


def test_word_hashes_do_not_depend_on_chunks(monkeypatch):
    from paylens.llm import arrays

    texts = pa.array(["a bb  ccc", None, "", "x" * 9000 + " y", "bb", " bb\n"])
    raw, at = arrays.text_bytes(texts)
    whole, begins = arrays.word_hashes(raw, at, lower=False)
    monkeypatch.setattr(arrays, "CHUNK_BYTES", 3)
    parts, again = arrays.word_hashes(raw, at, lower=False)
    assert whole.tolist() == parts.tolist() and begins.tolist() == again.tolist() == [0, 3, 3, 3, 5, 6, 7]
    assert whole[1] == whole[5] == whole[6]


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(129, 200), (7, 7)]
    links += [(300, 299), (299, 298), (500, 500)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.id: r.component for r in connected_components(frame, Scratch(spark, "t"), "c").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 100,
                   298: 298, 299: 298, 300: 298}


def test_rows_of_one_id_are_one_document(spark):
    words = [f"w{i}" for i in range(60)]
    a, b, c = " ".join(words), " ".join(f"v{i}" for i in range(60)), " ".join(f"u{i}" for i in range(60))
    rows = [(1, a), (2, b), (3, a), (3, b + " more"), (4, c), (5, c + " more"), (5, None), (5, "few words"), (6, "few  words"), (8, "few"),
            (9, a + " again"), (9, a + " again")]
    expected = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 8: 8, 9: 1}
    rng = np.random.default_rng(4)
    for parts in (1, 2, 3, 5):
        order = rng.permutation(len(rows))
        docs = spark.createDataFrame([rows[i] for i in order], "doc_id bigint, text string").repartition(parts)
        got = cm.near_duplicates(docs, 2, 80).collect()
        assert len(got) == len(rows) and {r.doc_id: r.component_id for r in got} == expected
        assert all(r.component_id == expected[r.doc_id] for r in got)


def test_columns_with_dots_and_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(1, text, "x", 5, [1]), (2, text, "y", 6, [2]), (3, "z", None, None, None)],
                                 "doc_id bigint, text string, `a.b` string, `id` int, `x``y` array<int>")
    kept = cm.deduplicate(docs)
    assert kept.columns == docs.columns
    assert {tuple(r)[:4] for r in kept.collect()} == {(1, text, "x", 5), (3, "z", None, None)}


def test_crafted_words_have_different_hashes():
    from paylens.llm import arrays

    word = ["a"]
    for _ in range(11):
        word += ["b" if c == "a" else "a" for c in word]
    one = "".join(word)
    raw, at = arrays.text_bytes(pa.array([one + " " + one.translate({97: 98, 98: 97}), "ab ba a b aa", one]))
    found, begins = arrays.word_hashes(raw, at, lower=True)
    assert begins.tolist() == [0, 2, 7, 8] and len(set(found.tolist())) == 7 and found[0] == found[7]
