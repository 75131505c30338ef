import json
import random
import re

import pytest
from pyspark.sql import functions as F

from paylens.functions.json_fields import BLANK, kind_sql, stripped
from paylens.plans.validation import validate_file
from paylens.sources.jsonl import (
    NOT_JSON, NOT_OBJECT, numbered, placed_lines, read_json_lines, read_lines, split_index, with_records)


def test_line_numbers_over_many_splits(spark, tmp_path):
    random.seed(1)
    expected = {}
    for name in ("a.json", "b.json", "c.txt"):
        lines = ["" if random.random() < 0.1 else json.dumps({"n": i, "pad": "x" * (i % 70)})
                 for i in range(1, 5001)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        if name.endswith(".json"):
            expected[name] = {i: text for i, text in enumerate(lines, 1) if text}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_lines(spark, str(tmp_path), "*.json")
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = {}
        for r in rows.collect():
            got.setdefault(r["source_file"].rsplit("/", 1)[1], {})[r["line_number"]] = r["line"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == expected


def test_split_size_may_change_after_the_scan(spark, tmp_path):
    lines = [f"line {i} " + "y" * (i % 50) for i in range(1, 4001)]
    (tmp_path / "a.json").write_text("\n".join(lines))
    name, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set(name, "30000")
        placed = placed_lines(spark, str(tmp_path))
        spark.conf.set(name, "7000")
        got = {r["line_number"]: r["line"] for r in numbered(placed).collect()}
    finally:
        spark.conf.set(name, before)
    assert got == dict(enumerate(lines, 1))


def test_malformed_lines_are_all_kept(spark, tmp_path):
    cases = [
        ('{"a": 1}', None), ('{"a": {"b": "}"}}', None), ("   ", "blank"), ('{"a": ', NOT_JSON),
        ("[1, 2]", NOT_OBJECT), ("5", NOT_OBJECT), ('"x"', NOT_OBJECT), ('{"a":1} junk', NOT_JSON),
        ('{"a":1}{"b":2}', NOT_JSON), ('{"a":1}]', NOT_JSON), ('{"a":1}}', NOT_JSON),
        ('{"a":{"b":1}}],[', NOT_JSON), ('{"a":{"b":1}},"c":{"d":1}', NOT_JSON),
        ("{'a':1}", NOT_JSON), ('{"a":1,}', NOT_JSON), ('  {"a": "{"}  ', None), ("null", NOT_OBJECT),
    ]
    (tmp_path / "f.json").write_text("\n".join(c for c, _ in cases))
    got = {r["line_number"]: r["problem"] for r in read_json_lines(spark, str(tmp_path)).collect()}
    assert got == {i: p for i, (_, p) in enumerate(cases, 1) if p != "blank"}


def decoded(line):
    """(problem, record) as a plain decoder sees the line; None for a blank one."""
    text = line.strip()
    if not text:
        return None
    try:
        record = json.loads(text)
    except json.JSONDecodeError:
        return NOT_JSON, None
    return (None, record) if isinstance(record, dict) else (NOT_OBJECT, None)


GRAMMAR = [
    '{"a": 1, "a": 2}', '{"a": {"b": 1, "b": 2}, "a": 3}', '{"a": NaN}', '{"a": Infinity}', '{"a": -Infinity}', '{"a": INF}',
    '{"a": +INF}', '{"a": -INF}', '{"a": +1}', '{"a": +Infinity}', '{"a": "INF"}', '{"a": "x, INF", "b": NaN}', '{"a": nan}', "{'a': 1}",
    '{a: 1}', '{"a": 01}', '{"a": 1.}', '{"a": .5}', '{"a": 1e5}', '{"a": 0x1}', '{"a": True}', '{"a": 1,}', '{"a": 1, /* c */ "b": 2}',
    '\u00a0', '\u3000 \u2003', '\x1c', '\u00a0{"a": 1}\u3000', '\u200b', '\ufeff{"a": 1}', '{"a":\u00a01}', '{"a": "\t"}', '{"a": "\\x"}',
    '{"a": "\\u12"}', '{"a": "\\ud800"}', '{}', '[]', '', 'NaN', '"x"', '[{"a": 1}]', '{"a": 1}{"a": 1}', '{"a": [1, 2}', '{"": 1}', '{"a" 1}',
    '{"a": [NaN, {"b": Infinity}]}', '{"a": 123456789012345678901234567890}', '{"a": 1e999}', '{"a": -0.0}',
]


def test_grammar_is_the_decoders(spark, tmp_path):
    (tmp_path / "g.json").write_text("\n".join(GRAMMAR))
    rows = read_json_lines(spark, str(tmp_path)).withColumn("kind", F.expr(kind_sql("record", "a"))).withColumn(
        "names", F.expr("array_sort(map_keys(try_variant_get(record, '$', 'map<string,variant>')))")).collect()
    got = {r["line_number"]: r for r in rows}
    assert set(got) == {i for i, line in enumerate(GRAMMAR, 1) if decoded(line)}
    kinds = {str: "STRING", bool: "BOOLEAN", type(None): "VOID"}
    for i, r in got.items():
        problem, record = decoded(GRAMMAR[i - 1])
        assert r["problem"] == problem, GRAMMAR[i - 1]
        if record is not None:
            assert r["names"] == sorted(record), GRAMMAR[i - 1]
            a = record.get("a")
            if type(a) in kinds and "a" in record:
                assert r["kind"] == kinds[type(a)]
            elif isinstance(a, float):
                assert r["kind"].startswith(("DOUBLE", "DECIMAL", "BIGINT")), GRAMMAR[i - 1]


def test_malformed_lines_carry_the_decoders_message(spark, tmp_path):
    lines = [line for line in GRAMMAR if (decoded(line) or (None,))[0]]
    (tmp_path / "m.json").write_text("\n".join(["", *lines, " "]))
    found = validate_file(spark, "customers", str(tmp_path / "m.json")).failures.collect()
    expected = []
    for i, line in enumerate(lines, 2):
        try:
            json.loads(line.strip())
            expected.append((i, NOT_OBJECT, line.strip()))
        except json.JSONDecodeError as error:
            expected.append((i, error.msg, line.strip()))
    assert sorted((r["line_number"], r["message"], r["invalid_value"]) for r in found) == expected


def test_numbers_that_are_none(spark, tmp_path):
    from conftest import customer

    lines = [json.dumps(customer(i, **change)) for i, change in enumerate(
        [{"customer_age": float("nan")}, {"customer_age": float("inf")}, {"customer_age": float("-inf")}, {"state": float("nan")}, {}], 1)]
    lines += [json.dumps(customer(6))[:-1] + ', "customer_age": 30, "state": "CA"}']
    (tmp_path / "n.json").write_text("\n\n".join(lines))
    outcome = validate_file(spark, "customers", str(tmp_path / "n.json"))
    got = sorted((r["line_number"], r["rule"], r["message"]) for r in outcome.failures.collect())
    assert got == sorted([
        (1, "type", "nan is not of type 'integer'"), (3, "type", "inf is not of type 'integer'"),
        (3, "maximum", "inf is greater than the maximum of 120"), (5, "type", "-inf is not of type 'integer'"),
        (5, "minimum", "-inf is less than the minimum of 18"), (7, "type", "nan is not of type 'string'")])
    assert outcome.valid_rows.count() == 2


@pytest.mark.parametrize("most", [1 << 20, 3])
def test_numbering_moves_no_text(spark, tmp_path, most):
    for name in "abc":
        (tmp_path / f"{name}.json").write_text("\n".join(f"{name}{i} " + "z" * (i % 60) for i in range(1, 3001)))
    settings = {"spark.sql.files.maxPartitionBytes": "9000", "spark.sql.autoBroadcastJoinThreshold": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        placed = placed_lines(spark, str(tmp_path))
        index = split_index(placed)
        assert index.count() > 12
        rows = numbered(placed, index, most)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        got = [(r["line_number"], r["line"]) for r in rows.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == 9000 and all(line[1:].split()[0] == str(n) for n, line in got)


def test_failures_of_a_scan_have_numbers(spark, tmp_path):
    from conftest import customer

    lines = ["" if i % 7 == 0 else json.dumps(customer(i, **({"state": "N1"} if i % 50 == 1 else {}))) for i in range(1, 2001)]
    (tmp_path / "c.json").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        outcome = validate_file(spark, "customers", str(tmp_path / "c.json"))
        got = sorted(r["line_number"] for r in outcome.failures.collect())
        assert got == [i for i in range(1, 2001) if i % 50 == 1 and i % 7]
        assert outcome.valid_rows.count() == sum(1 for i in range(1, 2001) if i % 7) - len(got)
        assert "split_start" not in outcome.failures.columns
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_blanks_are_taken_off_the_ends_without_a_pattern(spark):
    """A pattern tries every run of blanks inside a line, at a cost of its length squared."""
    blanks = [chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000 and re.match(f"[{BLANK}]", chr(i))]
    inner = "x" + "".join(blanks) + "y"
    rows = spark.createDataFrame([(b + inner + b * 2, inner) for b in blanks] + [(inner, inner), ("".join(blanks), "")],
                                 "line string, want string")
    assert rows.filter(stripped(F.col("line")) != F.col("want")).isEmpty() and rows.count() == len(blanks) + 2
    plan = with_records(rows.select("line"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace(line" not in plan and "RLIKE(_text" not in plan


def test_paths_are_taken_apart_once_per_file(spark, tmp_path):
    """Decoding a path for every line took longer than reading the line."""
    from paylens.functions.identifiers import plain_uri
    from paylens.sources.files import count_records

    for name in ("a+b.json", "c d%41.json"):
        (tmp_path / name).write_text('{"a": 1}\n\n{"a": 2}\n')
    counts = count_records(spark, str(tmp_path), "*.json")
    assert sorted((r["path"].rsplit("/", 1)[1], r["record_count"]) for r in counts.collect()) == [
        ("a+b.json", 2), ("c d%41.json", 2)]
    # The raw path is the key; what decodes it comes after the counts.
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "replace(" in plan and "replace(" not in plan.partition("Aggregate")[2].partition("\n")[2]
    rows = read_json_lines(spark, str(tmp_path), "*.json", lambda path: F.substring_index(plain_uri(path), "/", -1))
    assert "substring_index" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["file_name"], r["line_number"]) for r in rows.collect()) == [
        ("a+b.json", 1), ("a+b.json", 3), ("c d%41.json", 1), ("c d%41.json", 3)]


def test_most_lines_are_searched_once(spark):
    """Searching every line for braces and plus signs took a good part of each parse."""
    cases = [
        ('{"a": "x+y"}', None), ('{"a": +1}', NOT_JSON), ('{"a": 1e+5}', None), ('{"a": INF}', NOT_JSON),
        ('{"a": "INF"}', None), ('{"a": -Infinity}', None), ("{}", None), ("{", NOT_JSON),
        ('\u3000{"a": +1} ', NOT_JSON), ('{"a": "x"}\n', None), ('{"a": "x"}\n{"b": 1}', NOT_JSON),
        (" {} ", None), ('{"a": "}"}', None), ("{" + " " * 200_000, NOT_JSON), ('{"a": "é\u2028"}', None)]
    rows = with_records(spark.createDataFrame(cases, "line string, want string"))
    assert [(r["line"][:30], r["problem"], r["record"] is None) for r in rows.collect()] == [
        (line[:30], want, want is not None) for line, want in cases]
    assert "RLIKE(line" in rows._jdf.queryExecution().optimizedPlan().toString()
