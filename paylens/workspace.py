"""Session settings, the shared scratch folder and Hadoop file operations."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNTIME_SETTINGS = {
    # Runtime re-planning: small sides become broadcast joins after their true
    # size is known, hot shuffle partitions are split, tiny ones are merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also split a hot key when the join's output partitioning is reused.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # RAW keeps JSON as VARIANT; shredding stores its members as Parquet
    # columns, so the bronze casts read only the members they ask for.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    # JSON with a repeated name is valid; its last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JVM never compiles methods above 8000 bytes; let wide projections be
    # generated in pieces instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


# Folders handed out inside the innermost scope, to be deleted at its end.
_TAKEN: ContextVar[list[str] | None] = ContextVar("taken", default=None)


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(app: str = "paylens", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    spark = builder.getOrCreate()
    if not spark.conf.get("spark.checkpoint.dir", None):
        # a static setting: only a new session of this single JVM can carry it
        spark.stop()
        spark = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="paylens-")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``.

    ``local_session`` sets one when it is unset; any other session without it
    is refused, because a machine-local folder would not be shared.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
    path = f"{base.rstrip('/')}/paylens/{label}-{uuid.uuid4().hex}"
    taken = _TAKEN.get()
    if taken is not None:
        taken.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete every scratch folder taken inside, whether the work succeeds or not."""
    taken: list[str] = []
    token = _TAKEN.set(taken)
    try:
        yield
    finally:
        _TAKEN.reset(token)
        for path in taken:
            Storage(spark).delete(path)


#: Of tables; about half the size of what Spark's default leaves.
TABLE_CODEC = "zstd"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and go on from the files.

    Later passes read only the columns they need and survive lost executors.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path, compression=TABLE_CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a statement go when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


#: Driver heap, in bytes, that planning and running one of several jobs may take.
JOB_HEAP = 512 << 20


def workers_for(jobs: int) -> int:
    """How many of some independent jobs run at once: as many as the driver's heap has room for."""
    spark = SparkSession.getActiveSession()
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory() if spark else JOB_HEAP
    return max(1, min(jobs, heap // JOB_HEAP))


def together(jobs: dict[str, Callable[[], object]]) -> dict:
    """Submit independent jobs at once, so small ones share the cluster, within the driver's memory.

    All run to their end; the first failure in the given order is then raised.
    """
    with ThreadPoolExecutor(max_workers=workers_for(len(jobs))) as pool:
        running = {name: pool.submit(copy_context().run, job) for name, job in jobs.items()}
    return {name: future.result() for name, future in running.items()}


def small_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A handful of driver values as a DataFrame, without starting Python workers."""
    names = [column.split()[0] for column in schema.split(", ")]
    text = json.dumps([dict(zip(names, row)) for row in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema}>>")))


class Storage:
    """Small control files and whole-directory operations on any Hadoop filesystem."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def is_empty(self, path: str) -> bool:
        """True when nothing at all lies below ``path``."""
        return not self.exists(path) or len(self._fs(path).listStatus(self._path(path))) == 0

    def qualified(self, path: str) -> str:
        return self._fs(path).makeQualified(self._path(path)).toString()

    def read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Replace a control file; readers see the old or the new text, never a part."""
        draft = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self._fs(draft).create(self._path(draft), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        self.replace(draft, path)

    def replace(self, source: str, target: str) -> None:
        """Rename over an existing target in one step."""
        self._move(source, target, self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE)

    def _move(self, source: str, target: str, *chosen) -> None:
        options = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), len(chosen))
        for i, option in enumerate(chosen):
            options[i] = option
        source = self.qualified(source)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path(source).toUri(), self._conf)
        context.rename(self._path(source), self._path(self.qualified(target)), options)

    def rename(self, source: str, target: str) -> bool:
        """Directory rename in one step; False when something is at the target already.

        The filesystem itself refuses an existing target, so of two writers
        exactly one succeeds.
        """
        try:
            self._move(source, target)
        except Py4JJavaError as error:
            kind = error.java_exception.getClass().getSimpleName()
            if kind == "FileAlreadyExistsException" or self.exists(target):
                return False
            raise
        return True

    def children(self, path: str) -> list[str]:
        """Full paths of what lies directly below ``path`` (hidden names too)."""
        return [s.getPath().toString() for s in self._fs(path).listStatus(self._path(path))]

    def make_dirs(self, path: str) -> None:
        self._fs(path).mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)
