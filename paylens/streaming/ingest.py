"""Continuous file ingest: every new .json file is landed once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paylens.functions.identifiers import plain_uri
from paylens.functions.json_fields import is_blank
from paylens.sources.jsonl import with_records


@dataclass(frozen=True)
class Arrivals:
    """How files are taken from the watched folder."""

    name_filter: str = "*.json"
    #: Files of one micro-batch; after a backlog the rest follows in the next ones.
    files_per_trigger: int = 1000
    #: Files the source remembers from one listing for the next batches, instead of listing anew.
    cached_files: int = 10_000
    #: A file this much older than the newest one is not looked at: what the source has to remember.
    max_file_age: str = "3650d"
    #: Folder outside the watched one for ingested files; the watched folder then stays short.
    archive: str | None = None


def read_new_records(spark: SparkSession, folder: str, arrivals: Arrivals = Arrivals(),
                     loaded_at: str | None = None) -> DataFrame:
    """Streaming rows of files appearing below ``folder``: raw_record, source_file, loaded_at, and
    for a malformed line instead of a record its text and problem.

    Blank lines are skipped.  Without ``loaded_at`` a row has its micro-batch's time.
    """
    reader = (
        spark.readStream.option("pathGlobFilter", arrivals.name_filter)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", arrivals.files_per_trigger)
        .option("maxCachedFiles", arrivals.cached_files)
        .option("maxFileAge", arrivals.max_file_age))
    if arrivals.archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", arrivals.archive)
    lines = reader.text(folder).select(
        F.col("value").alias("line"), plain_uri(F.col("_metadata.file_path")).alias("source_file"),
    ).filter(~is_blank(F.col("line")))
    load_time = F.lit(loaded_at) if loaded_at else F.current_timestamp()
    return with_records(lines).select(
        F.col("record").alias("raw_record"), "source_file",
        load_time.cast("timestamp_ntz").alias("loaded_at"),
        F.when(F.col("problem").isNotNull(), F.col("line")).alias("bad_line"), "problem")


def ingest(spark: SparkSession, folder: str, table: str, checkpoint: str,
           continuous: str | None = None, arrivals: Arrivals = Arrivals(),
           loaded_at: str | None = None) -> StreamingQuery:
    """Append new records, and malformed lines as such, to the Parquet ``table``.

    One bad line neither stops the query nor gets lost: ``records`` and
    ``quarantined`` read the two kinds.  The checkpoint remembers ingested files, and the sink's log makes each
    micro-batch count once.  Without ``continuous`` (a processing interval such
    as "1 minute") everything present is ingested and the query ends.
    """
    writer = (
        read_new_records(spark, folder, arrivals, loaded_at).writeStream.format("parquet")
        .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(processingTime=continuous) if continuous \
        else writer.trigger(availableNow=True)
    return writer.start(table)


def records(spark: SparkSession, table: str) -> DataFrame:
    """The ingested records with the file they came in."""
    return spark.read.parquet(table).filter("problem is null").select("raw_record", "source_file", "loaded_at")


def quarantined(spark: SparkSession, table: str) -> DataFrame:
    """The lines that were no JSON objects, with the reason."""
    return spark.read.parquet(table).filter("problem is not null").select(
        "bad_line", "problem", "source_file", "loaded_at")


def loaded_rows(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("loaded_rows"))


def latest_records(table: DataFrame, field: str = "transaction_id", limit: int = 10) -> DataFrame:
    """The newest landed records; a top-k, never a full sort."""
    return table.select(
        F.variant_get("raw_record", f"$.{field}", "string").alias(field), "loaded_at",
    ).orderBy(F.desc("loaded_at"), field).limit(limit)
