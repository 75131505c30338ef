"""Intermediate tables of one operator call, below the cluster's shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylens.workspace import Storage, scratch_dir

#: Rows and bytes of one Arrow batch: a few long texts must not fill a worker.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def bounded_batches(rows: DataFrame) -> DataFrame:
    """``rows``, with the session's Arrow batches bounded in rows and bytes."""
    for name, value in BATCH_SETTINGS.items():
        rows.sparkSession.conf.set(name, value)
    return rows


class Scratch:
    """Named tables that are written once and read from the shared files, so a
    lost executor costs its tasks only; ``drop`` removes those no longer read."""

    def __init__(self, spark: SparkSession, label: str):
        self._spark = spark
        self._root = scratch_dir(spark, label)
        for name, value in BATCH_SETTINGS.items():
            spark.conf.set(name, value)

    def settle(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        path = f"{self._root}/{name}"
        df.write.option("compression", compression).parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        Storage(self._spark).delete(f"{self._root}/{name}")
