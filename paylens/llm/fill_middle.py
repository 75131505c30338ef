"""Fill-in-the-middle rows by one counted-quantifier match per document.

A unit is a line with its line end, or what follows the last one.  The number of
units n comes from ``regexp_count``; two hashes of the id choose the cuts
a <= b among 0..n.  Each row then has its own pattern

    ^((?:unit){a}+)((?:unit){b-a}+)(rest)$

and one ``regexp_replace`` writes prefix, middle and suffix in the order of its
form.  Counted groups are possessive: Java runs these in a loop, where a
backtracking group would recurse once per line.  Everything is a column
expression, one pass without a shuffle.

Nulls and edge cases: a null text counts as empty; an empty text, one that holds
a marker and one outside the transformed share stay plain: their output is the
text, prefix and middle are null.  A null id is hashed as the empty string.
Repeated rows are transformed alike.  Very long texts are matched whole.  An
empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def _draw(seed: int, group: int) -> Column:
    """The ``group``-th run of 8 hex digits of the id's hash, as an unsigned integer."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("bigint")


def transform(docs: DataFrame, share: int = 100, spm_share: int = 50, seed: int = 7) -> DataFrame:
    """doc_id, text (never null), n, form, prefix_chars, middle_chars, output of every row.

    ``share`` of 100 documents are cut, ``spm_share`` of 100 of these have their
    suffix first.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("bigint"))
    cuts = [_draw(seed, i) % (F.col("n") + 1) for i in (0, 1)]
    plain = (F.col("text") == "") | (_draw(seed, 2) % 100 >= share)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain |= F.contains(F.col("text"), F.lit(marker))
    rows = rows.select(
        "*", F.least(*cuts).alias("first"), F.greatest(*cuts).alias("second"),
        F.when(plain, "plain").when(_draw(seed, 3) % 100 < spm_share, "spm").otherwise("psm").alias("form"))
    pattern = F.concat(
        F.lit(f"(?s)^((?:{UNIT}){{"), F.col("first").cast("string"), F.lit(f"}}+)((?:{UNIT}){{"),
        (F.col("second") - F.col("first")).cast("string"), F.lit("}+)(.*)$"))
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(
        f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    rows = rows.withColumn(
        "output", F.when(F.col("form") == "plain", F.col("text")).otherwise(
            F.regexp_replace(F.col("text"), pattern, order)))
    at = {m: F.instr("output", m) for m in (PREFIX, SUFFIX, MIDDLE)}
    prefix_end = F.when(F.col("form") == "spm", at[MIDDLE]).otherwise(at[SUFFIX])
    cut = F.col("form") != "plain"
    return rows.select(
        "doc_id", "text", "n", "form",
        F.when(cut, prefix_end - at[PREFIX] - len(PREFIX)).cast("bigint").alias("prefix_chars"),
        F.when(cut, F.length("output") - at[MIDDLE] - len(MIDDLE) + 1).cast("bigint").alias("middle_chars"),
        "output")


def restored(rows: DataFrame) -> Column:
    """The text that ``output`` and ``form`` hold."""
    form, output = F.col("form"), F.col("output")
    psm = F.regexp_replace(output, F.lit(f"(?s)^{PREFIX}(.*){SUFFIX}(.*){MIDDLE}(.*)$"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(f"(?s)^{SUFFIX}(.*){PREFIX}(.*){MIDDLE}(.*)$"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(rows: DataFrame) -> DataFrame:
    """The transformed rows with hashes in place of their texts."""
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(rows), 256).alias("restored_sha256"))


def oracle(share: int = 100, spm_share: int = 50, seed: int = 7) -> str:
    """The same result in DuckDB SQL, from lists of lines."""
    draws = ", ".join(f"('0x' || substr(h, {8 * i + 1}, 8))::bigint as h{i + 1}" for i in range(4))
    joined = "array_to_string({}, '')"
    return f"""with t as (select doc_id, coalesce(text, '') as text,
            regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') as units,
            sha256('{seed}:' || coalesce(doc_id::varchar, '')) as h from documents),
    d as (select *, len(units) as n, {draws} from t),
    c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
            case when text = '' or contains(text, '{PREFIX}') or contains(text, '{SUFFIX}')
                or contains(text, '{MIDDLE}') or h3 % 100 >= {share} then 'plain'
                when h4 % 100 < {spm_share} then 'spm' else 'psm' end as form from d),
    p as (select *, {joined.format("units[1:a]")} as prefix, {joined.format("units[a + 1:b]")} as middle,
            {joined.format("units[b + 1:]")} as suffix from c),
    o as (select *, case form when 'plain' then text
            when 'spm' then '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle
            else '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle end as output from p)
    select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
        case when form <> 'plain' then length(middle) end as middle_chars,
        sha256(output) as output_sha256, sha256(text) as restored_sha256 from o"""
