"""Session helpers: where intermediate tables go and how a table is cut from its lineage."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

_local_dirs: dict[str, str] = {}
_stored: dict[tuple, tuple[tuple, str, StructType]] = {}
_scopes: dict[tuple[str, str], list[str]] = {}
_open_scopes: list[list[str]] = []


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    A local session without that setting (tests) gets a temporary folder. A cluster session
    without it is an error, since executors cannot see a folder of the driver's machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="epiweave-")
    return _local_dirs[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    app = spark.sparkContext.applicationId
    path = f"{work_root(spark)}/epiweave/{app}/{name}-{uuid.uuid4().hex[:12]}"
    for paths in _open_scopes:
        paths.append(path)
    return path


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that :func:`work_path` named, on whatever file system they are."""
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def replacing(spark: SparkSession, scope: str):
    """Tables stored inside the block replace those of the last block with this name.

    A result that reads stored tables stays readable after its block, until the next one begins.
    """
    key = (spark.sparkContext.applicationId, scope)
    discard(spark, _scopes.pop(key, []))
    paths = _scopes[key] = []
    _open_scopes.append(paths)
    try:
        yield
    finally:
        _open_scopes[:] = [held for held in _open_scopes if held is not paths]


def _write(df: DataFrame, path: str, partition_by: list[str] | None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    columns = ["`" + name.replace("`", "``") + "`" for name in schema.fieldNames()]
    return spark.read.schema(schema).parquet(path).select(*columns)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Later steps then start from files that outlive any executor, read only the columns they
    need, and are planned with true sizes instead of estimates.
    """
    path = work_path(df.sparkSession, name)
    _write(df, path, partition_by)
    return _read(df.sparkSession, path, df.schema)


def _state_of(spark: SparkSession, origin: str) -> tuple:
    """Names, sizes and times of the files of a folder and of the folders in it; empty if ``origin`` is no folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(origin)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(place):
        return ()
    top = list(system.listStatus(place))
    inner = [s for status in top if status.isDirectory() for s in system.listStatus(status.getPath())]
    return tuple(sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in top + inner))


def stored_table(
    spark: SparkSession, name: str, origin: str, build: Callable[[], DataFrame],
    partition_by: list[str] | None = None,
) -> DataFrame:
    """A materialized table that is built once per application and folder ``origin``, then read.

    If its files have gone, or files of the folder have changed since, it is built again.
    """
    key, state = (spark.sparkContext.applicationId, name, origin), _state_of(spark, origin)
    if key in _stored and _stored[key][0] == state:
        try:
            return _read(spark, *_stored[key][1:])
        except AnalysisException:
            del _stored[key]
    df, path = build(), work_path(spark, name)
    _write(df, path, partition_by)
    _stored[key] = (state, path, df.schema)
    return _read(spark, path, df.schema)


#: A table of more bytes than this is never sent to all tasks by these helpers.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(stored: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``stored`` (a materialized table) marked for broadcast if its values are measured to be small, else as it is."""
    sizes = [F.coalesce(F.octet_length(f.name), F.lit(0)) if isinstance(f.dataType, StringType) else F.lit(8) for f in stored.schema]
    size = stored.agg(F.sum(reduce(lambda a, b: a + b, sizes).cast("bigint") + 16)).first()[0]
    return F.broadcast(stored) if (size or 0) <= limit else stored


def together(jobs: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Submit independent jobs at the same time and wait for all of them."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}
