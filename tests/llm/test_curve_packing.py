import numpy as np
from tokenizers import Tokenizer

from paylens.llm import curve_packing as packing
from paylens.llm.catalog import tokenizer_path

PATH = tokenizer_path()


def expected_ids(text):
    tokenizer = Tokenizer.from_file(PATH)
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, sequence_id string")
    pieces = [r.asDict() for r in packing.pack(docs, PATH).collect()]
    by_doc = {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0
        by_doc.setdefault(p["doc_id"], []).append(p)
    seen = set()
    for i, text, _ in rows:
        if i in seen:
            continue
        seen.add(i)
        ids, times = expected_ids(text), sum(r[0] == i for r in rows)
        found = sorted(by_doc[i], key=lambda p: p["start"])
        assert sum(p["length"] for p in found) == times * len(ids)
        assert {p["doc_tokens"] for p in found} == {len(ids)}
        if times == 1:
            assert b"".join(bytes(p["ids"]) for p in found) == np.array(ids, "<i4").tobytes()
            assert [p["start"] for p in found] == np.cumsum([0, *(p["length"] for p in found)])[:-1].tolist()
    assert set(by_doc) == seen
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        lengths.append(at)
    assert sorted(sequences) == list(range(len(sequences)))
    assert all(n == packing.SEQUENCE or n & (n - 1) == 0 for n in lengths)
    assert sum(n != packing.SEQUENCE for n in lengths) <= 12
    digest = {(r.doc_id, r.start, r.ids_crc32) for r in packing.digests(packing.pack(docs, PATH)).collect()}
    if len(seen) == len(rows):
        assert digest == {(p["doc_id"], p["start"], packing.ids_checksum(np.frombuffer(p["ids"], "<i4").tolist()))
                          for p in pieces}


def test_every_id_lies_in_one_piece(spark):
    rng = np.random.default_rng(2)
    words = ["Straße", "it's", "don't", "x́", "ÀÉ", "12", "a--b", "<|endoftext|>", "日本", "w,", "KelvinK"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 400))), "x") for i in range(60)]
    rows += [(100, None, "x"), (101, "", "x"), (102, "the cat " * 6000, "x"), (103, " a b\x1cc\n\td", "x"),
             (None, "no id", "x")]
    check(spark, rows)


def test_totals_at_sequence_borders_and_repeated_rows(spark):
    check(spark, [(1, "a " * 4095, "x")])
    check(spark, [(1, "a " * 4095, "x"), (2, None, "x")])
    check(spark, [(1, "a " * 700, "x"), (1, "a " * 700, "x"), (2, "b " * 9000, "x"), (2, "b " * 9000, "x")])


def test_added_tokens_are_encoded_as_such(spark):
    rows = [(1, "hello <|endoftext|> world", "x"), (2, "<|startoftext|>a<|endoftext|><|endoftext|>", "x"), (3, "<|EndOfText|>", "x"),
            (4, "<|endoftext", "x"), (5, "a <|endoftext|>" * 3000, "x"), (6, "<|endoftext|>", "x"), (7, "plain", "x")]
    assert expected_ids(rows[0][1]) == [3306, 49407, 1002, packing.END_ID]
    check(spark, rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.digests(packing.pack(docs, PATH)).count() == 0


def test_curve_visits_neighbours():
    side = np.arange(16)
    points = np.array([(a, b, c) for a in side for b in side for c in side])
    keys = packing.hilbert_key(points, bits=4)
    assert sorted(keys.tolist()) == list(range(16 ** 3))
    steps = np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_memory_of_words_starts_anew(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 2)
    known = packing.WordIds(PATH)
    for words in ({b"a", b"b"}, {b"c", b"a"}):
        known.learn(words)
        assert set(known) >= words and known[b"a"] == np.array(expected_ids("a")[:-1], "<u2").tobytes()


def test_cuts_between_letters_and_marks_leave_ids_alone():
    from paylens.llm.arrays import text_bytes
    import pyarrow as pa

    texts = ["a.b", "It's. 's", "x!'s", "('s)", "a--b-", "é.a", "a\u0301.b", "..a1.b2", "", "don't!!", "a.", ".a", "_a_b", "K.k",
             "a\u2026.b", "\u2026.'re.", "`a`^b", "œuvre Œuvre ÿŸ ŉ ſs ĳ ª º µ", "naïve-été", "İstanbul ıǆ Ǆ", "e\u0301t\u00e9"]
    known = packing.WordIds(PATH)
    for text, words in zip(texts, packing.plain_words(*text_bytes(pa.array(texts)))):
        known.learn(set(words))
        assert np.frombuffer(b"".join(known[w] for w in words), "<u2").tolist() == expected_ids(text)[:-1], text
