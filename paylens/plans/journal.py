"""What a batch has already done, so that a rerun goes on where the last one ended.

A stage's entry names its inputs by digest and its outputs by the inventory
digest of their folders.  A later run skips the stage when the inputs are the
same and the folders still hold exactly the recorded files: they are hashed
again in parallel, which costs one read instead of the work.  Entries are
written after their stage, so a stage that died has none.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from paylens.functions.identifiers import utc_text
from paylens.operators.inventory import inventory_sha256
from paylens.sources.files import describe_files
from paylens.workspace import Storage


def digest_of(*values: object) -> str:
    return hashlib.sha256(json.dumps([str(v) for v in values]).encode()).hexdigest()


class Journal:
    def __init__(self, spark: SparkSession, root: str, run_id: str, resume: bool):
        self._spark, self._resume = spark, resume
        self._folder = f"{root}/journals/{run_id}"
        self._storage = Storage(spark)

    def folder_digest(self, folder: str) -> str | None:
        """Inventory digest of a folder; None when it is absent or nobody asks."""
        if not self._resume or not self._storage.exists(folder):
            return None
        return inventory_sha256(describe_files(self._spark, folder)).first()[0]

    def proof(self, folders: list[str]) -> str:
        return digest_of(*[self.folder_digest(f) for f in folders])

    def _entry(self, stage: str) -> dict | None:
        path = f"{self._folder}/{stage}.json"
        if not self._storage.exists(path):
            return None
        try:
            return json.loads(self._storage.read_text(path))
        except json.JSONDecodeError:
            return None

    def run(self, stage: str, inputs: str, outputs: Callable[[], str], work: Callable[[], object]) -> tuple[str, bool]:
        """(digest of the stage's outputs, whether it was skipped).

        ``outputs`` looks at what is there now.  Without ``resume`` the work is
        done and nothing is hashed or entered.
        """
        if not self._resume:
            work()
            return "", False
        entry = self._entry(stage)
        if entry and entry["inputs"] == inputs and entry["outputs"] == outputs():
            return entry["outputs"], True
        path = f"{self._folder}/{stage}.json"
        self._storage.delete(path)
        work()
        proof = outputs()
        self._storage.make_dirs(self._folder)
        self._storage.write_text(path, json.dumps(
            {"stage": stage, "inputs": inputs, "outputs": proof, "done_at_utc": utc_text()}, indent=2))
        return proof, False
