"""A contract compiled to Columns (no per-record Python).

Every (field, keyword) pair of a contract is a numbered rule.  A record gets the
array of rule numbers it breaks; only broken records also get the quoted values
that messages need, and only their failures are expanded to rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.contracts import HARD_FAIL, Dataset
from paylens.functions.calendar import FORMAT_CHECKS
from paylens.functions.json_fields import as_variant, kind_sql, numeric_sql, stripped
from paylens.functions.patterns import java_pattern

RULE_GROUPS = {"schema": 0, "unique": 1, "referential_integrity": 2, "late_arriving_event": 3}


def failure(group: str, seq, field: Column, rule, severity: str, message: Column) -> Column:
    """seq orders failures inside one record; rule_group orders whole rule families."""
    def column(value):
        return value if isinstance(value, Column) else F.lit(value)

    return F.struct(
        F.lit(RULE_GROUPS[group]).alias("rule_group"),
        column(seq).alias("seq"),
        field.alias("field"),
        column(rule).alias("rule"),
        F.lit(severity).alias("severity"),
        message.alias("message"),
    )


@dataclass(frozen=True)
class Rule:
    """``text`` follows the quoted value at position ``value`` (0 names unknown members,
    -1 quotes nothing).  ``broken`` is a SQL predicate."""

    field: str
    keyword: str
    broken: str
    value: int
    text: str


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _literal(text: str) -> str:
    return "r\"" + text + "\""


def _members(dataset: Dataset) -> str:
    return f"array({_list(dataset.field_names)})"


def _unknown(dataset: Dataset) -> str:
    """Names of the parsed record that the contract does not have."""
    return f"array_except(map_keys(try_variant_get(record, '$', 'map<string,variant>')), {_members(dataset)})"


def _has_unknown(dataset: Dataset) -> str:
    """Whether there are such names.  An object has at most one member more than its line has
    commas, so where all of them are known ones, nobody has to list them."""
    known = " + ".join(f"int(_kind_{n} is not null)" for n in dataset.field_names)
    most = "octet_length(line) - octet_length(replace(line, ',', '')) + 1"
    return f"{most} <> {known} and size({_unknown(dataset)}) > 0"


def with_members(parsed: DataFrame, dataset: Dataset) -> DataFrame:
    """Kind and typed value of every contract field, each extracted once.

    ``_kind_*`` is the member's JSON kind (see ``functions.json_fields``),
    ``_string_*`` the text of JSON strings, ``_number_*`` the value of numbers.
    """
    kinds = parsed.selectExpr("*", *[
        f"{kind_sql('record', f.name)} as _kind_{f.name}" for f in dataset.fields])
    values = []
    for f in dataset.fields:
        if f.kind in ("number", "integer"):
            values.append(f"case when {numeric_sql(f'_kind_{f.name}')} then "
                          f"try_variant_get(record, '$.{f.name}', 'double') end as _number_{f.name}")
        elif f.kind == "string":
            values.append(f"case when _kind_{f.name} = 'STRING' then "
                          f"try_variant_get(record, '$.{f.name}', 'string') end as _string_{f.name}")
    return kinds.selectExpr("*", *values)


def contract_rules(dataset: Dataset) -> list[Rule]:
    """Rules in report order: record-level ones, then fields by name.

    An absent field breaks only ``required``: every other predicate is NULL.
    """
    rules = []
    if dataset.closed:
        rules.append(Rule("record", "additionalProperties", _has_unknown(dataset), 0, " unexpected)"))
    rules += [Rule("record", "required", f"_kind_{n} is null", -1, f"'{n}' is a required property")
              for n in dataset.required_names]
    for f in sorted(dataset.fields, key=lambda f: f.name):
        kind, number, string = f"_kind_{f.name}", f"_number_{f.name}", f"_string_{f.name}"
        quoted = dataset.field_names.index(f.name) + 1

        def add(keyword: str, broken: str, text: str) -> None:
            rules.append(Rule(f.name, keyword, broken, quoted, text))

        add("type", {
            "string": f"{kind} <> 'STRING'",
            "boolean": f"{kind} <> 'BOOLEAN'",
            "number": f"{kind} is not null and {number} is null",
            "integer": f"{kind} is not null and ({number} is null or {number} <> floor({number}))",
        }[f.kind], f" is not of type '{f.kind}'")
        if f.enum:
            add("enum", f"{kind} is not null and not coalesce({string} in ({_list(f.enum)}), false)",
                f" is not one of [{_list(f.enum)}]")
        if f.pattern:
            add("pattern", f"not {string} rlike {_literal(java_pattern(f.pattern))}",
                f" does not match '{f.pattern}'")
        if f.minimum is not None:
            add("minimum", f"{number} < {f.minimum}", f" is less than the minimum of {f.minimum}")
        if f.maximum is not None:
            add("maximum", f"{number} > {f.maximum} and not isnan({number})", f" is greater than the maximum of {f.maximum}")
        if f.exclusive_minimum is not None:
            add("exclusiveMinimum", f"{number} <= {f.exclusive_minimum}",
                f" is less than or equal to the minimum of {f.exclusive_minimum}")
        if f.exclusive_maximum is not None:
            add("exclusiveMaximum", f"{number} >= {f.exclusive_maximum} and not isnan({number})",
                f" is greater than or equal to the maximum of {f.exclusive_maximum}")
        if f.min_length is not None:
            add("minLength", f"length({string}) < {f.min_length}",
                " should be non-empty" if f.min_length == 1 else " is too short")
        if f.max_length is not None:
            add("maxLength", f"length({string}) > {f.max_length}", " is too long")
        if f.format:
            add("format", f"{string} is not null and not {FORMAT_CHECKS[f.format].format(v=string)}",
                f" is not a '{f.format}'")
    return rules


def with_broken_rules(parsed: DataFrame, dataset: Dataset) -> DataFrame:
    """Add the contract members and ``broken``: the numbers of the rules a record
    breaks, empty when it conforms, NULL for a malformed line."""
    cases = ", ".join(
        f"case when {r.broken} then {i} end" for i, r in enumerate(contract_rules(dataset)))
    # array_except drops the NULLs of unbroken rules and, unlike array_compact,
    # keeps all rule predicates inside generated code.
    return with_members(parsed, dataset).selectExpr(
        "*", f"case when problem is null then array_except(array({cases}), "
             "array(cast(null as int))) end as broken")


def expand_broken_rules(rows: DataFrame, dataset: Dataset) -> DataFrame:
    """One row per broken rule of ``rows`` (line, broken, …) with its ``failure``.

    Quoted values are extracted here, for broken records only, so that the
    check of all records stays small.
    """
    unknown = _unknown(dataset)
    named = (f"concat('Additional properties are not allowed (', "
             f"'\\'', array_join(array_sort({unknown}), '\\', \\''), '\\'', "
             f"if(size({unknown}) = 1, ' was', ' were'))")
    quoted = ", ".join([named] + [_quoted_sql(n) for n in dataset.field_names])
    record = rows.withColumn("record", as_variant(stripped(F.col("line"))))
    each = record.selectExpr(
        "*", *[f"{kind_sql('record', n)} as _kind_{n}" for n in dataset.field_names],
    ).selectExpr(*rows.columns, f"array({quoted}) as quoted", "explode(broken) as number")
    return each.withColumn("failure", rule_failure(dataset, "number", "quoted"))


def _quoted_sql(name: str) -> str:
    text = f"try_variant_get(record, '$.{name}', 'string')"
    return (f"case _kind_{name} when 'STRING' then concat('\\'', {text}, '\\'') "
            f"when 'VOID' then 'None' when 'BOOLEAN' then initcap({text}) "
            f"else case {text} when 'NaN' then 'nan' when 'Infinity' then 'inf' when '-Infinity' then '-inf' "
            f"else {text} end end")


def rule_failure(dataset: Dataset, number: str, quoted: str) -> Column:
    """The failure struct of one broken rule, looked up in a constant table."""
    table = ", ".join(
        f"named_struct('field', '{r.field}', 'keyword', '{r.keyword}', 'value', {r.value}, "
        f"'text', {_literal(r.text)})" for r in contract_rules(dataset))
    rule = F.expr(f"get(array({table}), {number})")
    value = F.when(rule["value"] < 0, "").otherwise(F.get(F.col(quoted), rule["value"]))
    return failure("schema", F.col(number), rule["field"], rule["keyword"], HARD_FAIL,
                   F.concat(value, rule["text"]))
