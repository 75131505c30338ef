"""JSON-lines scan with line numbers and every malformed line kept.

Numbers never move text.  Lines are written once with their split and their
place in it; an index of the splits (one short row each) then gives every split
its first number, and meets the lines in joins of bounded, explicitly broadcast
parts.  Whatever only needs to tell rows apart uses ``PLACE`` and resolves
numbers for the few rows it shows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylens.functions.json_fields import as_variant, is_blank, stripped
from paylens.workspace import settle

NOT_JSON = "Line is not valid JSON."
NOT_OBJECT = "JSON line must contain an object."

#: Where a line lies: its file, the first byte of its split, and an id that rises within the split.
PLACE = ["source_file", "split_start", "row_id"]
#: Splits that one broadcast part of the index may hold (about 100 bytes each).
INDEX_SPLITS = 500_000



def with_records(lines: DataFrame) -> DataFrame:
    """Add ``record`` (VARIANT, NULL when malformed) and ``problem`` to ``line`` rows.

    The JSON reader stops after the first value, so ``{"a":1} junk`` would pass.
    Inside an object wrapper only ``,`` or ``}`` may follow the value, inside an
    array wrapper only ``,`` or ``]``; no trailing text satisfies both.  A line
    with a single pair of braces around it has no room for a second value and is
    parsed once, as it is.  One anchored pattern knows such lines without a plus
    sign; only the others are searched for braces and plus signs.  Each step is a
    column of its own, so nothing is parsed twice.  The reader also takes INF and a
    leading plus sign, which are no JSON in any dialect.
    """
    text, simple, flat, plain, wrapped = (F.col(c) for c in ("_text", "_simple", "_flat", "_plain", "_wrapped"))
    bare_of_braces = F.replace(F.replace(text, F.lit("{"), F.lit("")), F.lit("}"), F.lit(""))
    listed = as_variant(F.concat(F.lit("["), text, F.lit("]")))
    bare = F.regexp_replace(text, r'"(?:[^"\\]++|\\.)*+"', "")
    words = ~(text.contains("INF") | (~simple & text.contains("+"))) | ~bare.rlike(r"INF|(?<![0-9][eE])[+]")
    whole = (plain.isNotNull() | (wrapped.isNotNull() & listed.isNotNull())) & words
    return (
        lines.withColumn("_text", stripped(F.col("line")))
        .withColumn("_simple", F.col("line").rlike(r"\A\{[^{}+]*\}\z"))
        .withColumn("_flat", simple | (text.startswith("{") & text.endswith("}") & (
            F.octet_length(bare_of_braces) == F.octet_length(text) - 2)))
        .withColumn("_plain", F.when(flat, as_variant(text)))
        .withColumn("_wrapped", F.when(~flat, as_variant(F.concat(F.lit('{"r":'), text, F.lit("}")))))
        .withColumn("problem", F.when(~whole, NOT_JSON).when(~text.startswith("{"), NOT_OBJECT))
        .withColumn("record", F.when(
            F.col("problem").isNull(), F.coalesce(plain, F.try_variant_get(wrapped, "$.r", "variant"))))
        .select(*lines.columns, "record", "problem"))


def _explained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        messages = []
        for line in batch["line"]:
            try:
                json.loads(line.strip())
                messages.append(NOT_JSON)
            except (json.JSONDecodeError, RecursionError) as error:
                messages.append(getattr(error, "msg", NOT_JSON))
        batch["problem"] = messages
        yield batch


def explained(malformed: DataFrame) -> DataFrame:
    """Rows with a line that is not valid JSON, with the decoder's message as ``problem``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in malformed.schema)
    return malformed.mapInPandas(_explained, schema)


def _text_reader(spark: SparkSession, name_filter: str | None):
    reader = spark.read.option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", name_filter) if name_filter else reader


def plain_lines(spark: SparkSession, path: str, name_filter: str | None = None) -> DataFrame:
    """source_file, line of non-blank lines, without numbers: one scan, nothing stored."""
    return _text_reader(spark, name_filter).text(path).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line"),
    ).filter(~is_blank(F.col("line")))


def scanned_lines(spark: SparkSession, path: str, name_filter: str | None = None) -> DataFrame:
    """All lines, blank ones too, with their ``PLACE``; to be written before anything is numbered.

    Whatever is computed from the written table sees the same splits, however
    later scans of the files would cut them.
    """
    # The id is taken directly above the scan: it rises with the position in a split.
    return _text_reader(spark, name_filter).text(path).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row_id"),
        F.col("value").alias("line"))


def placed_lines(spark: SparkSession, path: str, name_filter: str | None = None) -> DataFrame:
    """``scanned_lines``, written once."""
    return settle(scanned_lines(spark, path, name_filter), "lines")


def split_index(placed: DataFrame, named: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per split of a written table with all lines' ``PLACE``: the scan task and the ids
    it holds, and the number of lines before it in its file.

    ``named`` makes another name of a file's path, once per split, which ``numbered`` hands on
    as ``file_name``.
    """
    per_split = placed.groupBy("source_file", "split_start").agg(
        F.min("row_id").alias("first_id"), F.max("row_id").alias("last_id"), F.count("*").alias("lines"))
    earlier = (
        Window.partitionBy("source_file").orderBy("split_start")
        .rowsBetween(Window.unboundedPreceding, -1))
    return settle(per_split.select(
        _task(F.col("first_id")).alias("task"), "first_id", "last_id",
        F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("lines_before"),
        *([named(F.col("source_file")).alias("file_name")] if named else [])), "splits")


def _task(row_id: Column) -> Column:
    """Ids of one scan task share their upper bits; a task reads one split or some small ones."""
    return F.shiftright(row_id, 33)


def numbered(rows: DataFrame, index: DataFrame | None = None, most: int = INDEX_SPLITS) -> DataFrame:
    """``rows`` with the 1-based ``line_number`` inside its file in the place of ``split_start``
    and ``row_id``.

    ``index`` is the ``split_index`` of the written table that all rows come
    from; without it ``rows`` must be that table.  An index of more than ``most``
    splits is cut by scan tasks; each part is broadcast to the rows of its tasks.
    So rows are never shuffled, at any size.
    """
    index = split_index(rows) if index is None else index
    size = index.agg(F.count("*").alias("splits"), F.coalesce(F.max("task"), F.lit(0)).alias("last")).first()
    parts, found = max(1, -(-size["splits"] // most)), None
    width = -(-(size["last"] + 1) // parts)
    names = [c for c in rows.columns if c not in PLACE]
    names += [c for c in ("file_name",) if c in index.columns]
    lost = F.raise_error(F.concat(F.lit("No line count for a split of "), F.col("source_file")))
    for part in range(parts):
        own, starts = rows, index
        if parts > 1:
            low, high = part * width, (part + 1) * width
            own = own.filter((F.col("row_id") >= low << 33) & (F.col("row_id") < high << 33))
            starts = starts.filter((F.col("task") >= low) & (F.col("task") < high))
        joined = own.join(F.broadcast(starts), (_task(F.col("row_id")) == F.col("task")) & (
            F.col("row_id").between(F.col("first_id"), F.col("last_id"))), "left")
        number = F.col("row_id") - F.col("first_id") + F.col("lines_before") + 1
        joined = joined.select("source_file", F.coalesce(number, lost.cast("bigint")).alias("line_number"), *names)
        found = joined if found is None else found.unionByName(joined)
    return found


def read_lines(spark: SparkSession, path: str, name_filter: str | None = None,
               named: Callable[[Column], Column] | None = None) -> DataFrame:
    """Non-blank lines with their 1-based number inside the file; files stay splittable."""
    placed = placed_lines(spark, path, name_filter)
    return numbered(placed, split_index(placed, named)).filter(~is_blank(F.col("line")))


def read_json_lines(spark: SparkSession, path: str, name_filter: str | None = None,
                    named: Callable[[Column], Column] | None = None) -> DataFrame:
    """source_file, line_number, line, record, problem — one row per non-blank line (and
    ``file_name`` with ``named``, see ``split_index``)."""
    return with_records(read_lines(spark, path, name_filter, named))


def scan_json_lines(spark: SparkSession, path: str, name_filter: str | None = None) -> DataFrame:
    """PLACE, line, blank, record, problem of all lines, to be written by who goes on with them."""
    return with_records(scanned_lines(spark, path, name_filter).withColumn("blank", is_blank(F.col("line"))))
