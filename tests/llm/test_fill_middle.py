import hashlib
import re

from paylens.llm import fill_middle


def expected(doc_id, text, share=100, spm=50, seed=7):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= share:
        return doc_id, n, "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = ["", None, "one", "one\n", "\n", "\n\n\n", "a\nb\nc", "a\r\nb c\x85d\n\ne", "has <P> in it\nx", "<M", "<S>",
         "$1 \\ $2\n{3}+ (x)\n", "é😀\n" * 9, "< P>\n<\nS>\n<", "line of text\n" * 40_000, "x" * 2_000_000 + "\n" + "y" * 9,
         " \t\n \n", "\x00\n\x00", "a\nb\nc"]


def rows_of(spark):
    return [(i, t) for i, t in enumerate(TEXTS * 3)] + [(None, "a\nb\nc\nd"), (-5, "a\nb\nc\nd"), (7, "e\nf"), (7, "e\nf")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, `n.form` string").withColumnRenamed(
        "n.form", "n")


def test_rows_equal_a_plain_version(spark):
    rows = rows_of(spark)
    found = fill_middle.transform(frame(spark, rows)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()
    assert sorted(map(tuple, found), key=str) == sorted((expected(*r) for r in rows), key=str)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_texts_come_back_and_shares_hold(spark):
    rows = rows_of(spark) + [(i, "a\nb\nc\n") for i in range(1000, 3000)]
    docs = frame(spark, rows)
    for share, spm in ((100, 50), (30, 100), (0, 0)):
        done = fill_middle.transform(docs, share, spm, seed=11)
        found = done.select("doc_id", "form", fill_middle.restored(done).alias("back")).collect()
        assert sorted(((r.doc_id, r.back) for r in found), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
        cut = [r.form for r in found if r.doc_id is not None and r.doc_id >= 1000 and r.form != "plain"]
        assert abs(len(cut) / 2000 - share / 100) < 0.05
        assert not cut or abs(cut.count("spm") / len(cut) - spm / 100) < 0.05


def test_empty_table_and_native_plan(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    done = fill_middle.digests(fill_middle.transform(docs))
    assert done.count() == 0
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
