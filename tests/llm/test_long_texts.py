"""Long documents are learnt from, by windows spread over them."""

import pytest
from pyspark.sql import functions as F

from paylens.llm import compression_toxicity as toxicity
from paylens.llm import language_id as language
from paylens.llm.sampling import WINDOWS, spread

SCHEMA = "doc_id bigint, text string, lang string"
LONG = toxicity.SAMPLE_MAX_CHARS


def test_windows_reach_from_begin_to_end(spark):
    short, long = "é" * 64, "".join(chr(0x4E00 + i) for i in range(1000))
    got = [r.t for r in spark.createDataFrame([(short,), (long,), (None,)], "text string")
           .select(spread(F.col("text"), 64).alias("t")).collect()]
    parts = got[1].split(" ")
    assert got[0] == short and got[2] is None and len(parts) == WINDOWS
    assert all(len(p) == 4 and p in long for p in parts)
    assert parts[0] == long[:4] and parts[-1] == long[-4:]


def test_a_label_with_long_texts_only_is_learnt(spark):
    rows = [(i, ("you pathetic worthless idiot " if i % 2 else "the calm sea was wide and deep ") * 1200
             if i % 2 else "the calm sea was wide and deep " * 20, "en") for i in range(60)]
    assert all((len(r[1]) > LONG) == (r[0] % 2 == 1) for r in rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels)
    assert model is not None
    assert toxicity.score(docs, model).filter("predicted <> doc_id % 2").count() == 0
    with pytest.raises(ValueError, match="toxic label"):
        toxicity.fit(docs.filter("doc_id % 2 = 0"), labels)


def test_a_language_with_long_texts_only_is_predicted(spark):
    words = {"en": "the house and the dog were there with them ", "de": "der hund und das haus waren nicht dort "}
    rows = [(i, words[code] * (1200 if code == "de" else 20), code) for i, code in enumerate(["en", "de"] * 30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = language.predict(docs, language.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.filter("lang <> lang_pred").count() == 0
