"""JSON text as VARIANT, and a record's members: presence, JSON kind, text, number, typed key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as blank around a record.
BLANK = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# The same characters as plain text, for trimming without a pattern.
_BLANKS = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                            0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

NUMERIC = "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def numeric_sql(kind: str) -> str:
    """``kind`` is one of ``NUMERIC``, told by the beginning of its name."""
    return "(" + " or ".join(f"startswith({kind}, '{n}')" for n in ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")) + ")"


def is_blank(line: Column) -> Column:
    return ~line.rlike(f"[^{BLANK}]")


def stripped(line: Column) -> Column:
    """The line without blank characters around it; only its ends are looked at.

    A line that begins and ends with a brace has none; trimming lists every character.
    """
    return F.when(line.startswith("{") & line.endswith("}"), line).otherwise(F.btrim(line, F.lit(_BLANKS)))


def as_variant(text: Column) -> Column:
    """JSON text as VARIANT, NULL when malformed; NaN and Infinity are numbers.

    Of repeated names the last one wins (``spark.sql.variant.allowDuplicateKeys``).
    """
    return F.from_json(text, "variant", {
        "allowNonNumericNumbers": "true", "allowSingleQuotes": "false", "mode": "PERMISSIVE"})


def kind_sql(record: str, name: str) -> str:
    """STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID (JSON null), OBJECT<…>, ARRAY<…>;
    SQL NULL when the member is absent."""
    return f"schema_of_variant(try_variant_get({record}, '$.{name}', 'variant'))"


def member_kind(record: str, name: str) -> Column:
    return F.expr(kind_sql(record, name))


def member_text(record: str, name: str) -> Column:
    return F.expr(f"try_variant_get({record}, '$.{name}', 'string')")


def typed_key(record: str, kind: str, name: str, string: str | None = None) -> Column:
    """Join/group key in which the string "5" and the number 5 stay apart.

    Numbers and booleans compare by value (1, 1.0 and true are one key);
    absent and null members have no key.  ``string`` names a column that holds
    the text of JSON strings already.
    """
    text = f"try_variant_get({record}, '$.{name}', 'string')"
    exact = (f"regexp_replace(cast(try_variant_get({record}, '$.{name}', 'decimal(38,10)') "
             "as string), '[.]?0+$', '')")
    return F.expr(f"""
        case when {kind} = 'STRING' then concat('s:', {string or text})
             when {kind} = 'VOID' then null
             when {kind} = 'BOOLEAN' or {numeric_sql(kind)}
             then concat('n:', coalesce({exact}, {text}))
             else concat('j:', {text}) end""")


def key_literal(key: Column) -> Column:
    """A typed key as it is quoted in messages: strings in single quotes."""
    body = F.substring(key, 3, 2147483647)
    return F.when(key.startswith("s:"), F.concat(F.lit("'"), body, F.lit("'"))).otherwise(body)
