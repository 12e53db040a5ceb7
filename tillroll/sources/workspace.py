"""Tables written once to a folder that every executor can reach.

Long lineages are cut by writing a table and reading it back, so a lost
executor costs the re-read of a few files and never a re-run of the job.
Jobs that write a table remove their shuffle files when they end.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_LOCK = threading.RLock()
_ROOTS: dict[str, str] = {}
_LANDED: dict[tuple[str, str], tuple[str, StructType | None]] = {}
_SCRATCH = threading.local()
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Codec of tables that are stored for a while, smaller than the default one.
CODEC = "zstd"


def _shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that all executors can reach"
        )
    return tempfile.mkdtemp(prefix="tillroll-")


def work_folder(spark: SparkSession) -> str:
    """The folder of this application below the cluster's shared one."""
    app = spark.sparkContext.applicationId
    with _LOCK:
        if app not in _ROOTS:
            base = _shared_folder(spark).rstrip("/")
            _ROOTS[app] = f"{base}/tillroll-{app}-{uuid.uuid4().hex[:8]}"
        return _ROOTS[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the work folder that nothing else uses."""
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs that start inside remove their shuffle files when they end.

    Else the files stay until the driver happens to collect its garbage. A result that
    is needed twice must be planned twice, as every ``write`` does.
    """
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``land`` writes inside are deleted at the end, when nothing may read them any more."""
    outer, mine = getattr(_SCRATCH, "paths", None), []
    _SCRATCH.paths = mine
    try:
        yield
    finally:
        _SCRATCH.paths = outer
        for path in mine:
            _delete(spark, path)


def _store(df: DataFrame, path: str, mode: str = "error") -> None:
    with freed_shuffles(df.sparkSession):
        df.write.mode(mode).option("compression", CODEC).parquet(path)


def land(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the work folder and read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if (paths := getattr(_SCRATCH, "paths", None)) is not None:
        paths.append(path)
    _store(df, path)
    return spark.read.schema(df.schema).parquet(path)


def landed_once(
    spark: SparkSession, key: str, write: Callable[[str], StructType | None]
) -> tuple[str, StructType | None]:
    """Path of what ``write(path)`` stores on first use only, and the schema it returns."""
    app = spark.sparkContext.applicationId
    with _LOCK:
        if (app, key) not in _LANDED:
            path = fresh_path(spark, "set")
            schema = write(path)
            _LANDED[(app, key)] = (path, schema)
        return _LANDED[(app, key)]


def landed_table(spark: SparkSession, key: str, *builds: Callable[[], DataFrame]) -> DataFrame:
    """A table that is computed and written on first use and read from then on.

    Several builds give its rows part after part, so that only one part's shuffle
    files are on disk at a time.
    """

    def write(path: str) -> StructType:
        for build in builds:
            table = build()
            _store(table, path, "append")
        return table.schema

    path, schema = landed_once(spark, key, write)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def lent(spark: SparkSession, key: str) -> Iterator[None]:
    """What is first stored under the key inside is deleted at the end; what was there before stays.

    For a table that is only needed to build another one. A later use stores it again.
    """
    app = spark.sparkContext.applicationId
    with _LOCK:
        kept = (app, key) in _LANDED
        try:
            yield
        finally:
            if not kept and (app, key) in _LANDED:
                _delete(spark, _LANDED.pop((app, key))[0])


def clean_work_folder(spark: SparkSession) -> None:
    """Delete this application's own work folder, with every table landed in it.

    Call it when no result that reads landed tables is needed any more. Other
    folders below the shared one are never touched.
    """
    app = spark.sparkContext.applicationId
    with _LOCK:
        root = _ROOTS.pop(app, None)
        for key in [k for k in _LANDED if k[0] == app]:
            del _LANDED[key]
    if root:
        _delete(spark, root)
