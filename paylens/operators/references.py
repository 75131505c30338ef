"""Child rows whose key is not held by a valid parent row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.contracts import DATASETS, QUARANTINE, Dataset, Reference
from paylens.functions.json_fields import key_literal
from paylens.operators.schema_rules import failure


def key_column(field: str) -> str:
    return f"key_{field}"


def _message(dataset: Dataset, rule: Reference) -> Column:
    values = [key_literal(F.col(key_column(f))) for f in rule.fields]
    shown = F.concat(values[0], F.lit(",")) if len(values) == 1 else F.concat_ws(", ", *values)
    label = ", ".join(rule.fields)
    return F.concat(
        F.lit(f"{dataset.name}.({label}) value ("), shown,
        F.lit(f") does not reference a valid {rule.parent}.({label}) record."))


def missing_references(rows: DataFrame, dataset: Dataset,
                       valid_parents: dict[str, DataFrame]) -> DataFrame:
    """``rows`` plus ``failure``, one row per broken relationship.

    Every relationship leads with its parent's primary key, and a valid parent
    key occurs once (each copy of a repeated key is invalid).  One left join
    per parent therefore answers all of its relationships and cannot multiply
    rows.  Null keys are dropped before the shuffle; the child is the preserved
    side, so a hot child key can be split at run time.
    """
    found = None
    for parent in dict.fromkeys(r.parent for r in dataset.references):
        if parent not in valid_parents:
            raise RuntimeError(
                "Parent dataset has not been validated before child dataset: "
                f"{parent} required by {dataset.name}.")
        rules = [r for r in dataset.references if r.parent == parent]
        lead = key_column(DATASETS[parent].primary_key)
        others = sorted({key_column(f) for r in rules for f in r.fields} - {lead})
        parent_keys = valid_parents[parent].select(
            F.col(lead).alias("_lead"), *[F.col(c).alias(f"_{c}") for c in others])
        joined = rows.filter(F.col(lead).isNotNull()).join(
            parent_keys, F.col(lead) == F.col("_lead"), "left")
        broken = []
        for rule in rules:
            extras = [key_column(f) for f in rule.fields if key_column(f) != lead]
            complete, agrees = F.lit(True), F.col("_lead").isNotNull()
            for c in extras:
                complete = complete & F.col(c).isNotNull()
                agrees = agrees & F.coalesce(F.col(c) == F.col(f"_{c}"), F.lit(False))
            broken.append(F.when(complete & ~agrees, failure(
                "referential_integrity", dataset.references.index(rule),
                F.lit(", ".join(rule.fields)), "referential_integrity", QUARANTINE,
                _message(dataset, rule))))
        failed = joined.select(
            *[rows[c] for c in rows.columns],
            F.explode(F.array_compact(F.array(*broken))).alias("failure"))
        found = failed if found is None else found.unionByName(failed)
    return found
