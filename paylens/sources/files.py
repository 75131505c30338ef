"""File inventories: names, sizes, hashes and line counts, computed in tasks."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from paylens.functions.identifiers import plain_uri
from paylens.workspace import Storage, small_rows

CHUNK = 8 * 1024 * 1024
#: Names of JSON-lines files, plain or compressed.
JSON_FILES = "*.{json,json.gz}"
#: Records of a compressed file: it cannot be split, so it must not outgrow a task.
COMPRESSED_RECORDS = 500_000


def line_writer(rows: DataFrame, compressed: bool = False) -> DataFrameWriter:
    """A writer of text or JSON lines; compressed, they take a small part of the disk."""
    if not compressed:
        return rows.write
    return rows.write.options(
        compression="gzip", maxRecordsPerFile=COMPRESSED_RECORDS, **{"zlib.compress.level": "BEST_SPEED"})


def open_filesystem(uri: str, known: dict[str, object] | None = None):
    """(filesystem, path) of a Hadoop-style URI for use inside a task.

    ``known`` keeps one filesystem per scheme and host for the task.
    """
    from pyarrow import fs

    known = {} if known is None else known
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return known.setdefault(scheme, fs.LocalFileSystem()), "/" + rest.lstrip("/")
    if scheme in ("s3a", "s3n"):
        uri = "s3:" + rest
    place = "/".join(uri.split("/", 3)[:3])
    if place not in known:
        known[place], path = fs.FileSystem.from_uri(uri)
        return known[place], path
    return known[place], fs.FileSystem.from_uri(uri)[1]


def chunks(stream) -> Iterator[bytes]:
    while block := stream.read(CHUNK):
        yield block


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class RecordCounter:
    """Counts lines with something else than blanks, block by block."""

    def __init__(self):
        self.count, self._inside = 0, False

    def update(self, block: bytes) -> None:
        raw = np.frombuffer(block, np.uint8)
        said, ends = ~_SPACE[raw], (raw == 10) | (raw == 13)
        said = said[said | ends]  # True for a sign, False for a line's end
        if len(said):
            self.count += int(np.count_nonzero(said[1:] & ~said[:-1])) + int(said[0] and not self._inside)
            self._inside = bool(said[-1])


class Inflater:
    """The text of a gzip file, block by block; what is damaged ends it."""

    def __init__(self):
        self._member, self._damaged = zlib.decompressobj(wbits=31), False

    def update(self, block: bytes) -> Iterator[bytes]:
        more = not self._damaged
        while more:
            if self._member.eof and block:  # files of several members are one text
                self._member = zlib.decompressobj(wbits=31)
            try:
                text = self._member.decompress(block, CHUNK)
            except zlib.error:
                self._damaged = True
                return
            yield text
            block = self._member.unused_data if self._member.eof else self._member.unconsumed_tail
            more = bool(block) or len(text) == CHUNK


def _described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hash and record count of each file, from one pass over its bytes."""
    known: dict[str, object] = {}
    for batch in batches:
        digests, counts = [], []
        for uri in batch["path"]:
            filesystem, path = open_filesystem(uri, known)
            digest, records = hashlib.sha256(), RecordCounter()
            inflater = Inflater() if path.endswith(".gz") else None
            with filesystem.open_input_stream(path, compression=None) as stream:
                for block in chunks(stream):
                    digest.update(block)
                    for text in inflater.update(block) if inflater else [block]:
                        records.update(text)
            digests.append(digest.hexdigest())
            counts.append(records.count)
        yield batch.assign(sha256=digests, record_count=counts)


def list_files(spark: SparkSession, root: str, name_filter: str = "*") -> DataFrame:
    """relative_key, path, size — a listing; no file content is read."""
    prefix = spark._jvm.org.apache.hadoop.fs.Path(root)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    qualified = prefix.getFileSystem(conf).makeQualified(prefix).toString().rstrip("/")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_filter)
        .load(root)
        .select(
            F.expr(f"substring(path, {len(qualified) + 2})").alias("relative_key"),
            "path",
            F.col("length").alias("size"))
    )


def every_file(spark: SparkSession, root: str) -> DataFrame:
    """relative_key, path, size of all files below ``root``, also those with hidden names.

    The driver lists the top level only; tasks walk one sub-folder each.
    """
    storage = Storage(spark)
    top = storage.qualified(root).rstrip("/")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for uri in batch["uri"]:
                filesystem, path = open_filesystem(uri)
                info = filesystem.get_file_info(path)
                found = [info] if info.is_file else [
                    f for f in filesystem.get_file_info(fs.FileSelector(path, recursive=True)) if f.is_file]
                keys = [uri[len(top) + 1:] + f.path[len(path):] for f in found]
                yield pd.DataFrame({"relative_key": keys, "path": [f"{top}/{k}" for k in keys],
                                    "size": [f.size for f in found]})

    folders = small_rows(spark, [(u,) for u in storage.children(root)], "uri string")
    return folders.repartition(max(len(storage.children(root)), 1)).mapInPandas(
        walk, "relative_key string, path string, size bigint")


def with_sha256(files: DataFrame) -> DataFrame:
    """Hash and record count of each file, chunk by chunk, so file size is not limited.

    Round-robin spreading keeps large files from queueing in one task.
    """
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in files.schema)
    spread = files.repartition(files.sparkSession.sparkContext.defaultParallelism * 4)
    return spread.mapInPandas(_described, f"{schema}, sha256 string, record_count bigint")


def count_records(spark: SparkSession, root: str, name_filter: str = "*") -> DataFrame:
    """path, record_count — non-blank lines per file."""
    text = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_filter)
        .text(root)
    )
    # A path is decoded once per file and not once per line.
    return text.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count_if(F.col("value").rlike(r"\S")).alias("record_count"),
    ).withColumn("path", plain_uri(F.col("path")))


def describe_files(spark: SparkSession, root: str, name_filter: str = "*") -> DataFrame:
    """relative_key, size, sha256, record_count (0 for an empty file)."""
    return with_sha256(list_files(spark, root, name_filter)).select(
        "relative_key", "size", "sha256", "record_count")


def plain_key(path):
    """One spelling for ``file:/x`` and ``file:///x``."""
    return F.regexp_replace(path, "^file:/+", "file:/")
