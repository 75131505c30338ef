"""Run ids and the relative paths used in manifests."""

from __future__ import annotations

import re
import uuid
from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: YYYYMMDDTHHMMSSZ_ and eight lower-case hex digits.
RUN_ID_PATTERN = r"^[0-9]{8}T[0-9]{6}Z_[0-9a-f]{8}$"


def new_run_id(now: datetime | None = None) -> str:
    return f"{now or datetime.now(UTC):%Y%m%dT%H%M%SZ}_{uuid.uuid4().hex[:8]}"


def check_run_id(run_id: str) -> str:
    if not re.fullmatch(RUN_ID_PATTERN, run_id):
        raise ValueError(f"run ID must match YYYYMMDDTHHMMSSZ_aaaaaaaa: {run_id!r}")
    return run_id


def is_run_id(text: Column) -> Column:
    # Nothing may follow; in Java "$" lies before a line end, too.
    return text.rlike(RUN_ID_PATTERN.removesuffix("$") + r"\z")


def relative_key(path: Column) -> Column:
    """Forward slashes only and no leading slash."""
    return F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), "^/+", "")


def is_safe_dataset_path(path: Column, dataset: Column) -> Column:
    """``raw/<dataset>/…`` without an absolute start or a ``..`` step."""
    plain = F.replace(path, F.lit("\\"), F.lit("/"))
    steps = F.split(plain, "/")
    return (
        ~plain.startswith("/")
        & ~F.array_contains(steps, "..")
        & plain.startswith(F.concat(F.lit("raw/"), dataset, F.lit("/")))
    )


def plain_uri(path: Column) -> Column:
    """File metadata paths are percent-encoded; listings are not."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def utc_text(now: datetime | None = None) -> str:
    return (now or datetime.now(UTC)).isoformat().replace("+00:00", "Z")
