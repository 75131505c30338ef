import hashlib
import random

import pyarrow as pa
import pytest
import tiktoken

import public_tokenizers
from paylens.llm import class_scan_bpe as bpe
from paylens.llm.arrays import text_bytes
from paylens.llm.catalog import tokenizer_path

PATH = tokenizer_path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.Ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.rank,
                             special_tokens={})


EDGES = ["", " ", "  ", "\n", " \n a", "a  b", "a 　b", "it's we'll 're'x ''s 's", "'", "x'", "'l", "'re", "''ve",
         "1²½ a1", "é" * 700, "ab" * 3000, "q" * 101, "\x1c\x85​", "𝐀𝟘 \U0010ffff", "a\tb\r\n\r\n", "<|endoftext|>"]


def test_equals_the_library_on_random_and_edge_texts(ranks, library):
    rng = random.Random(3)
    alphabet = "abstvmredl'' \n\t  　" + "1²é中-!.,½\x1c\x85​𝐀"
    texts = EDGES + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    for text, (ids, pieces) in zip(texts, ranks.encode(*text_bytes(pa.array(texts)))):
        assert ids.tolist() == library.encode_ordinary(text), repr(text)
        assert ranks.decode(ids.tolist()) == text.encode()
        for (offset, first), following in zip(pieces.tolist(), [*pieces.tolist()[1:], [None, None]]):
            assert ranks.decode(ids[first:following[1]].tolist()) == text.encode()[offset:following[0]]


def test_classes_of_all_codepoints(ranks, library):
    codes = [c for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000] + list(range(0x3100))
    texts = [f"a{chr(c)}1{chr(c)} {chr(c)}b" for c in codes]
    for text, (ids, _) in zip(texts, ranks.encode(*text_bytes(pa.array(texts)))):
        assert ids.tolist() == library.encode_ordinary(text), repr(text)


def test_digests_of_a_table(spark, library):
    rows = [(i, t, "x") for i, t in enumerate([*EDGES, None])] + [(0, "", "x"), (None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = sorted(map(tuple, bpe.digests(bpe.encode(docs, PATH), PATH).collect()), key=str)
    expected = []
    for i, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(expected, key=str)
    assert bpe.digests(bpe.encode(docs.limit(0), PATH), PATH).count() == 0
