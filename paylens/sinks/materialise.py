"""Bronze as views, silver, gold and monitoring as Parquet tables per layer."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from paylens.plans.bronze import bronze_models
from paylens.plans.gold import gold_models
from paylens.plans.monitoring import pipeline_row_counts
from paylens.plans.silver import dispute_outcomes, transactions_enriched
from paylens.sinks.generations import Generation, commit, live_generation, reading
from paylens.sinks.promotion import read_raw
from paylens.workspace import TABLE_CODEC, Storage, together

# Schema of each layer.
LAYERS = {"bronze": "BRONZE", "silver": "SILVER", "gold": "MARTS", "monitoring": "MONITORING"}


def store(df: DataFrame, folder: str, layer: str, name: str) -> DataFrame:
    """Write one model as ``<folder>/<layer schema>/<name>`` and read it back."""
    path = f"{folder}/{LAYERS[layer]}/{name}"
    df.write.parquet(path, compression=TABLE_CODEC)
    return df.sparkSession.read.parquet(path)


def read_mart(spark: SparkSession, warehouse: str, name: str, generation: Generation | None = None) -> DataFrame:
    """A stored model of the live generation, or of one held by ``generations.reading``."""
    folder = (generation or live_generation(spark, warehouse)).models_folder(warehouse)
    if folder is None:
        raise FileNotFoundError(f"No models have been built in {warehouse}.")
    layer = "monitoring" if name.startswith("monitoring_") else "silver" if name.startswith("silver_") else "gold"
    return spark.read.parquet(f"{folder}/{LAYERS[layer]}/{name}")


def build_models(spark: SparkSession, warehouse: str, as_of: str | None = None) -> dict[str, DataFrame]:
    """All thirteen models of the live RAW tables, live at once and together.

    They are staged in a folder of their own and committed on the generation
    whose RAW tables they were built from; until then, and after any failure,
    the models built before stay live.
    """
    with reading(spark, warehouse) as base:
        version = uuid.uuid4().hex
        folder = f"{warehouse}/models/{version}"
        try:
            models = stage_models(read_raw(spark, warehouse, base), folder, as_of)
            commit(spark, warehouse, base, models=version)
        except Exception:
            Storage(spark).delete(folder)
            raise
    return models


def stage_models(raw: dict[str, DataFrame], folder: str, as_of: str | None = None) -> dict[str, DataFrame]:
    """All thirteen models in dependency order, stored in ``folder``.

    Each table is written before anything reads it, so silver joins run once
    and every mart scans only its columns of the stored silver table.
    """
    models: dict[str, DataFrame] = {}
    bronze = bronze_models(raw)
    for name, view in bronze.items():
        view.createOrReplaceTempView(f"br_{name}")
        models[f"br_{name}"] = view
    silver = {"silver_transactions_enriched": store(transactions_enriched(
        bronze["transactions"], bronze["customers"], bronze["fraud_signals"], as_of),
        folder, "silver", "silver_transactions_enriched")}
    silver["silver_dispute_outcomes"] = store(dispute_outcomes(
        bronze["disputes"], silver["silver_transactions_enriched"],
        bronze["chargeback_outcomes"], as_of), folder, "silver", "silver_dispute_outcomes")
    gold = together({n: partial(store, df, folder, "gold", n)
                     for n, df in gold_models(silver, bronze, as_of).items()})
    counts = store(pipeline_row_counts(raw, silver, gold, as_of), folder, "monitoring",
                   "monitoring_pipeline_row_counts")
    return models | silver | gold | {"monitoring_pipeline_row_counts": counts}
