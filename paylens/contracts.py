"""The five datasets: contracts, keys, event-time fields and relationships.

Everything here is plain data.  ``operators.schema_rules`` turns a contract
into Column expressions; nothing walks records in Python.  ``with_schema`` takes
a contract's fields from a JSON Schema document instead.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field as default, replace

CONTRACT_VERSION = "v1"


@dataclass(frozen=True)
class Field:
    """One contract property; unset keywords are not checked."""

    name: str
    kind: str
    enum: tuple[str, ...] = ()
    pattern: str | None = None
    minimum: float | None = None
    maximum: float | None = None
    exclusive_minimum: float | None = None
    format: str | None = None
    exclusive_maximum: float | None = None
    min_length: int | None = None
    max_length: int | None = None


@dataclass(frozen=True)
class Reference:
    """Child fields that must equal the same-named fields of one valid parent."""

    parent: str
    fields: tuple[str, ...]


@dataclass(frozen=True)
class Dataset:
    name: str
    primary_key: str
    event_field: str
    fields: tuple[Field, ...]
    references: tuple[Reference, ...] = default(default=())
    #: Names a record must have (None: all), and whether it may have others.
    required: tuple[str, ...] | None = None
    closed: bool = True

    @property
    def required_names(self) -> tuple[str, ...]:
        return self.field_names if self.required is None else self.required

    @property
    def file_name(self) -> str:
        return f"{self.name}.json"

    @property
    def field_names(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields)

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)


# The v1 contracts (patterns, value lists, bounds, formats).
DATE_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
DATE_TIME_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
CARD_NETWORKS = ("Mastercard", "Pulse", "Visa")


def _id(name: str, prefix: str, digits: int) -> Field:
    return Field(name, "string", pattern=f"^{prefix}_[0-9]{{{digits}}}$")


def _choice(name: str, *values: str) -> Field:
    return Field(name, "string", enum=values)


def _date(name: str) -> Field:
    return Field(name, "string", pattern=DATE_PATTERN, format="pipeline-date")


def _date_time(name: str) -> Field:
    return Field(name, "string", pattern=DATE_TIME_PATTERN, format="pipeline-date-time")


def widened(dataset: Dataset) -> Dataset:
    """The same contract with ids of at least, not exactly, the given number of digits."""
    return replace(dataset, fields=tuple(
        replace(f, pattern=re.sub(r"^(\^[A-Z]+_\[0-9\]\{[0-9]+)\}\$$", r"\1,}$", f.pattern)) if f.pattern else f
        for f in dataset.fields))


#: JSON Schema keywords of a field and where they are kept.
KEYWORDS = {"type": "kind", "enum": "enum", "pattern": "pattern", "minimum": "minimum", "maximum": "maximum",
            "exclusiveMinimum": "exclusive_minimum", "exclusiveMaximum": "exclusive_maximum",
            "minLength": "min_length", "maxLength": "max_length", "format": "format"}
KINDS = ("string", "number", "integer", "boolean")
#: Keywords that say nothing about records.
NOTES = {"$schema", "$id", "$comment", "title", "description", "examples", "default", "deprecated"}


def _schema_field(name: str, rules: object) -> Field:
    if not isinstance(rules, dict):
        raise ValueError(f"{name}: a field needs an object of keywords")
    unknown = set(rules) - set(KEYWORDS) - NOTES
    if unknown:
        raise ValueError(f"{name}: no rule for {', '.join(sorted(unknown))}")
    if not re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", name) or rules.get("type") not in KINDS:
        raise ValueError(f"{name}: a field needs a plain name and one type of {', '.join(KINDS)}")
    enum = rules.get("enum", ())
    if enum and (rules["type"] != "string" or not all(isinstance(v, str) for v in enum)):
        raise ValueError(f"{name}: only texts can be listed")
    texts = [rules[k] for k in ("pattern", "format") if k in rules]
    if any("'" in t or '"' in t for t in (*enum, *texts)):
        raise ValueError(f"{name}: quotes are not supported in values and patterns")
    return Field(name, rules["type"], **{
        KEYWORDS[k]: tuple(v) if k == "enum" else v for k, v in rules.items() if k in KEYWORDS and k != "type"})


def with_schema(dataset: Dataset, text: str) -> Dataset:
    """The dataset with the fields of a JSON Schema document (draft 2020-12).

    Keywords without a rule are refused, never skipped.  Keys, event time and
    relationships stay, and must be fields of the new contract.
    """
    schema = json.loads(text)
    unknown = set(schema) - NOTES - {"type", "additionalProperties", "required", "properties"}
    if unknown or schema.get("type") != "object" or not isinstance(schema.get("additionalProperties", True), bool):
        raise ValueError(f"{dataset.name}: not a schema of plain records ({', '.join(sorted(unknown)) or 'type'})")
    fields = tuple(_schema_field(n, rules) for n, rules in schema.get("properties", {}).items())
    names = tuple(f.name for f in fields)
    required = tuple(schema.get("required", ()))
    needed = {dataset.primary_key, dataset.event_field, *required, *(f for r in dataset.references for f in r.fields)}
    if needed - set(names):
        raise ValueError(f"{dataset.name}: no field {', '.join(sorted(needed - set(names)))}")
    return replace(dataset, fields=fields, closed=not schema.get("additionalProperties", True),
                   required=None if required == names else required)


def as_schema(dataset: Dataset) -> str:
    """The contract as a JSON Schema document; ``with_schema`` reads it back."""
    spelled = {v: k for k, v in KEYWORDS.items()}
    properties = {}
    for f in dataset.fields:
        values = {spelled[k]: getattr(f, k) for k in spelled}
        properties[f.name] = {k: list(v) if k == "enum" else v for k, v in values.items() if v not in (None, ())}
    return json.dumps({
        "$schema": "https://json-schema.org/draft/2020-12/schema", "title": f"{dataset.name} {CONTRACT_VERSION}",
        "type": "object", "additionalProperties": not dataset.closed, "required": list(dataset.required_names),
        "properties": properties}, indent=2)


CUSTOMERS = Dataset(
    "customers", "customer_id", "created_at",
    (
        _id("customer_id", "CUST", 6),
        _id("account_id", "ACCT", 6),
        Field("customer_age", "integer", minimum=18, maximum=120),
        _choice("account_status", "Active", "Closed", "Suspended"),
        Field("state", "string", pattern="^[A-Z]{2}$"),
        _date("created_at"),
    ),
)

TRANSACTIONS = Dataset(
    "transactions", "transaction_id", "transaction_timestamp",
    (
        _id("transaction_id", "TXN", 8),
        _id("customer_id", "CUST", 6),
        _id("account_id", "ACCT", 6),
        _id("merchant_id", "MERCH", 5),
        Field("transaction_amount", "number", exclusive_minimum=0),
        _date_time("transaction_timestamp"),
        _choice("transaction_status", "Approved", "Declined", "Reversed"),
        _choice("card_network", *CARD_NETWORKS),
        _choice("merchant_category",
                "Electronics", "Food", "Gas", "Online", "Retail", "Travel"),
        _choice("country", "US"),
    ),
    (
        Reference("customers", ("customer_id",)),
        Reference("customers", ("customer_id", "account_id")),
    ),
)

FRAUD_SIGNALS = Dataset(
    "fraud_signals", "transaction_id", "score_timestamp",
    (
        _id("transaction_id", "TXN", 8),
        Field("fraud_score", "number", minimum=0, maximum=1),
        _choice("risk_level", "Low", "Medium", "High"),
        _choice("rule_triggered",
                "Amount Spike", "High Amount", "New Device", "None",
                "Unusual Merchant", "Velocity Check", "Device Mismatch", "Geo Anomaly"),
        Field("device_risk_score", "number", minimum=0, maximum=1),
        Field("velocity_count", "integer", minimum=0),
        _choice("model_version", "v1.0", "v1.1", "v1.2"),
        _date_time("score_timestamp"),
    ),
    (Reference("transactions", ("transaction_id",)),),
)

DISPUTES = Dataset(
    "disputes", "dispute_id", "opened_date",
    (
        _id("dispute_id", "DISP", 7),
        _id("claim_id", "CLM", 7),
        _id("transaction_id", "TXN", 8),
        _choice("dispute_reason",
                "Duplicate Charge", "Fraud", "Incorrect Amount", "Product Not Received"),
        Field("dispute_amount", "number", exclusive_minimum=0),
        _choice("dispute_status", "Denied", "Opened", "Resolved", "Under Review"),
        _date("opened_date"),
        _choice("card_network", *CARD_NETWORKS),
    ),
    (Reference("transactions", ("transaction_id",)),),
)

CHARGEBACK_OUTCOMES = Dataset(
    "chargeback_outcomes", "chargeback_id", "resolved_date",
    (
        _id("chargeback_id", "CBK", 7),
        _id("dispute_id", "DISP", 7),
        _choice("outcome", "Lost", "Pending", "Won"),
        _choice("win_loss_flag", "Loss", "Pending", "Win"),
        Field("final_amount", "number", minimum=0),
        _date("resolved_date"),
        Field("representment_required", "boolean"),
    ),
    (Reference("disputes", ("dispute_id",)),),
)

# Parents come before their children; this is also the validation order.
DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (CUSTOMERS, TRANSACTIONS, FRAUD_SIGNALS, DISPUTES, CHARGEBACK_OUTCOMES)
}

# Severities and what each batch status lets the pipeline do.
HARD_FAIL = "hard_fail"
QUARANTINE = "quarantine_continue"
WARN = "warn_continue"
STATUS_ACTIONS = {
    "FAILED": "BLOCK_S3_UPLOAD",
    "PASSED_WITH_QUARANTINE": "UPLOAD_VALID_RECORDS_ONLY",
    "PASSED_WITH_WARNINGS": "UPLOAD_ALL_RECORDS",
    "PASSED": "UPLOAD_ALL_RECORDS",
}
LATE_AFTER_DAYS = 365
HIGH_RISK_SCORE = 0.35


def with_ancestors(name: str) -> tuple[str, ...]:
    """The dataset and every dataset it refers to, parents first."""
    needed, pending = set(), [name]
    while pending:
        current = pending.pop()
        if current not in needed:
            needed.add(current)
            pending += [r.parent for r in DATASETS[current].references]
    return tuple(n for n in DATASETS if n in needed)
