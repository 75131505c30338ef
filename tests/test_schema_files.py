import json
import re

import pytest
from pyspark.sql import functions as F

from conftest import clean_run, customer, failures_of
from paylens.contracts import DATASETS, as_schema, with_schema
from paylens.functions.identifiers import is_run_id
from paylens.functions.patterns import java_pattern
from paylens.plans.validation import load_contracts, validate_lines

PATTERNS = ["^[A-Z]{2}$", "^TXN_[0-9]{8}$", "a.c", "^a.*c$", r"\d+", r"^\w+$", r"\s", r"[\s]x", r"[^\d]$", r"x\Z", r"\Ax", "[$.]", r"\$\.",
            "a{2,3}", "(ab|c)+$", "(?:x|y)$", "(?=a)a$", "[]a]b", "[^]a]b", "[[]", r"[a\]b]c", "$", "^$", "[&&a]", r"\n$", r"[\w.-]+@x"]
TEXTS = ["NY\u2028", "a\u2028c", "x\u2029", "\u3000x", "\u2003", "NY", "NY\n", "NY\r", "NY\r\n", "NY ", "NY\x85", "NY\n\n", "ny", "TXN_00000001", "TXN_00000001\r", "abc", "a\nc", "a\rc", "a c",
         "a c\n", "٣٤", "12", "é_1", "a b", " x", "\x1cx", " x", "x\n", "x", "a1\n", "1", "$", ".", "$.", "aa", "aaa\n", "abab", "cab\r",
         "x ", "a", "]b", "ab", "bb", "[", "]c", "ac", "", "\n", "\r", "&", "&&a", "A.b-c@x", "日@x"]


def test_patterns_match_as_in_the_contract_dialect(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    found = rows.select("i", *[F.col("t").rlike(java_pattern(p)).alias(f"p{k}") for k, p in enumerate(PATTERNS)]).collect()
    for r in found:
        for k, p in enumerate(PATTERNS):
            assert r[f"p{k}"] == bool(re.search(p, TEXTS[r["i"]])), (p, TEXTS[r["i"]])


@pytest.mark.parametrize("pattern", [r"\bx", r"(?i)x", r"(?P<n>x)", r"[\D]", r"(?>x)", "("])
def test_unknown_constructs_are_refused(pattern):
    with pytest.raises((ValueError, re.error)):
        java_pattern(pattern)


def test_line_ends_do_not_pass(spark, parsed):
    rows = [customer(i, state="NY" + end) for i, end in enumerate(["", "\n", "\r", "\r\n", " ", "\x85"], 1)]
    outcome = validate_lines(parsed(rows), DATASETS["customers"], None)
    assert failures_of(outcome) == [(n, "state", "pattern") for n in (3, 4, 5, 6)]
    run = "20260730T040000Z_a1b2c3d4"
    ids = spark.createDataFrame([(run + end,) for end in ("", "\n", "\r", " ", "x")], "id string")
    assert [r[0] for r in ids.select(is_run_id(F.col("id"))).collect()] == [True, False, False, False, False]


def test_contracts_survive_their_documents():
    for dataset in DATASETS.values():
        assert with_schema(dataset, as_schema(dataset)) == dataset


def test_an_edited_document_changes_the_rules(spark, parsed):
    schema = json.loads(as_schema(DATASETS["customers"]))
    schema["properties"]["customer_age"]["exclusiveMaximum"] = 40
    schema["properties"]["note"] = {"type": "string", "minLength": 2, "maxLength": 3}
    schema["additionalProperties"] = True
    edited = with_schema(DATASETS["customers"], json.dumps(schema))
    assert edited.required_names == DATASETS["customers"].field_names and not edited.closed
    rows = [customer(1), customer(2, customer_age=39), customer(3, customer_age=39, note="x", other=1),
            customer(4, customer_age=39, note="😀😀"), customer(5, customer_age=39, note="long"), {"state": "NY"}]
    outcome = validate_lines(parsed(rows), edited, None)
    got = failures_of(outcome)
    assert got[:3] == [(1, "customer_age", "exclusiveMaximum"), (3, "note", "minLength"), (5, "note", "maxLength")]
    assert {(r, f) for _, f, r in got[3:]} == {("required", "record")} and len(got) == 8


@pytest.mark.parametrize("change", [
    {"minProperties": 1}, {"type": "array"}, {"properties": {"customer_id": {"type": "string", "const": "x"}}},
    {"properties": {"customer_id": {"type": ["string", "null"]}}}, {"properties": {"customer_id": {"type": "string"}}},
    {"required": ["nobody"]}, {"properties": {"a b": {"type": "string"}}}, {"additionalProperties": {"type": "string"}}])
def test_documents_without_rules_are_refused(change):
    schema = json.loads(as_schema(DATASETS["customers"])) | change
    with pytest.raises(ValueError):
        with_schema(DATASETS["customers"], json.dumps(schema))


def test_clean_run_is_still_clean(parsed):
    for name, records in clean_run().items():
        assert validate_lines(parsed(records), with_schema(DATASETS[name], as_schema(DATASETS[name])), None).failures.count() == 0


def test_a_folder_of_documents_is_a_suite_of_contracts(spark, tmp_path):
    for name, dataset in DATASETS.items():
        (tmp_path / f"{name}.schema.json").write_text(as_schema(dataset))
    assert load_contracts(spark, str(tmp_path)) == DATASETS
