"""Generations of a warehouse: which RAW version and which stored models belong together.

Generation n is the file ``generations/<n>.json``; it is never changed.  The
highest one is live.  Whoever wants to replace it stages folders of its own
and commits on the generation it started from: the next number's file appears
by one rename that fails when somebody else has taken the number.  So of two
loads at once one wins, the other one is told, and nobody sees half of anything.
A crash before the commit leaves the live generation as it was.

The live generation and the one before it keep their folders; older ones lose
them at a later commit, except while a reader holds a lease on them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from paylens.workspace import Storage

#: Seconds after which a lease that was not given back no longer counts.
LEASE_SECONDS = 24 * 3600


class ConcurrentCommit(RuntimeError):
    """Another commit replaced the generation that this one was built on."""


@dataclass(frozen=True)
class Generation:
    number: int = 0
    raw: str | None = None
    models: str | None = None

    def raw_folder(self, warehouse: str) -> str | None:
        return f"{warehouse}/raw/versions/{self.raw}" if self.raw else None

    def models_folder(self, warehouse: str) -> str | None:
        return f"{warehouse}/models/{self.models}" if self.models else None


def _file(warehouse: str, number: int) -> str:
    return f"{warehouse}/generations/{number:012d}.json"


def _read(storage: Storage, warehouse: str, number: int) -> Generation:
    return Generation(**json.loads(storage.read_text(_file(warehouse, number)))) if number else Generation()


def _numbers(storage: Storage, warehouse: str) -> list[int]:
    folder = f"{warehouse}/generations"
    if not storage.exists(folder):
        return []
    names = [path.rsplit("/", 1)[1] for path in storage.children(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def live_generation(spark: SparkSession, warehouse: str) -> Generation:
    """The last committed generation; number 0, without tables, before the first."""
    storage = Storage(spark)
    return _read(storage, warehouse, max(_numbers(storage, warehouse), default=0))


def commit(spark: SparkSession, warehouse: str, base: Generation, raw: str | None = None,
           models: str | None = None) -> Generation:
    """The generation after ``base`` with a new RAW version, new models, or both; what is not given stays.

    Raises ``ConcurrentCommit`` when ``base`` is no longer live.
    """
    storage = Storage(spark)
    following = Generation(base.number + 1, raw or base.raw, models or base.models)
    draft = f"{warehouse}/generations/.{uuid.uuid4().hex}.tmp"
    storage.make_dirs(f"{warehouse}/generations")
    storage.write_text(draft, json.dumps(asdict(following)))
    taken = not storage.rename(draft, _file(warehouse, following.number))
    # A number so old that its file is gone can be taken again; it never becomes the highest.
    if taken or max(_numbers(storage, warehouse)) != following.number:
        storage.delete(draft if taken else _file(warehouse, following.number))
        raise ConcurrentCommit(
            f"Generation {following.number} of {warehouse} was committed by somebody else; nothing was replaced.")
    _retire(storage, warehouse, following.number - 2)
    return following


def _leased(storage: Storage, warehouse: str) -> set[int]:
    folder = f"{warehouse}/leases"
    if not storage.exists(folder):
        return set()
    held = set()
    for path in storage.children(folder):
        number, since, _ = path.rsplit("/", 1)[1].split("-")
        if time.time() - int(since) < LEASE_SECONDS:
            held.add(int(number))
        else:
            storage.delete(path)
    return held


def _retire(storage: Storage, warehouse: str, last: int) -> None:
    """Delete the generations up to ``last`` that no reader holds, and their folders unless a kept one uses them.

    Folders that no generation names are left alone: somebody may be staging them.
    """
    leased, numbers = _leased(storage, warehouse), _numbers(storage, warehouse)
    kept = [_read(storage, warehouse, n) for n in numbers if n > last or n in leased]
    used = {f(g, warehouse) for g in kept for f in (Generation.raw_folder, Generation.models_folder)}
    for number in numbers:
        if number <= last and number not in leased:
            own = _read(storage, warehouse, number)
            for folder in {own.raw_folder(warehouse), own.models_folder(warehouse)} - used - {None}:
                storage.delete(folder)
            storage.delete(_file(warehouse, number))


@contextmanager
def reading(spark: SparkSession, warehouse: str) -> Iterator[Generation]:
    """The live generation, whose tables stay until the end of the block."""
    storage = Storage(spark)
    storage.make_dirs(f"{warehouse}/leases")
    while True:
        current = live_generation(spark, warehouse)
        lease = f"{warehouse}/leases/{current.number}-{int(time.time())}-{uuid.uuid4().hex}"
        storage.write_text(lease, "")
        # Taken in time if the generation is one of the last two even now.
        if live_generation(spark, warehouse).number <= current.number + 1:
            break
        storage.delete(lease)
    try:
        yield current
    finally:
        storage.delete(lease)
