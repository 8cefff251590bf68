"""Distributed writers of result tables.

A table that is replaced as a whole is a folder of versions. A new version is written next to the one in use, and one
rename switches to it. Whoever began to read the version before can finish, and a write that fails leaves everything as it was.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from epiweave.fixed import EXPORT_MAX_ROWS
from epiweave.session import discard
from epiweave.sources.readers import as_path

#: File that names the version in use.
CURRENT = "_current"
VERSION = re.compile(r"version-\d{20}-[0-9a-f]{8}")


class ExportTooLarge(ValueError):
    """The selection has more rows than an export may have."""


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header row, UTF-8 without a byte-order mark, one file per task."""
    df.write.mode("overwrite").options(
        header=True, encoding="UTF-8", escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write a Parquet table in place, by default partitioned by year so that year filters prune.

    Rows are brought together by partition value before the write, in several tasks per value
    (adaptive execution sizes them and splits a large year), instead of every task opening a
    file in every partition.
    """
    keys = ["ano"] if partition_by is None else partition_by
    if keys:
        df.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def _system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def current_version(spark: SparkSession, path: str) -> str | None:
    """The version in use of the table at ``path``; None before the first one is complete."""
    system, place = _system(spark, f"{path}/{CURRENT}")
    if not system.exists(place):
        return None
    jvm, stream = spark.sparkContext._jvm, system.open(place)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def versions(spark: SparkSession, path: str) -> list[str]:
    """Versions that are there, complete or not, the oldest first."""
    system, place = _system(spark, path)
    names = [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []
    return sorted(n for n in names if VERSION.fullmatch(n))


def _switch(spark: SparkSession, path: str, version: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    system, ready = _system(spark, f"{path}/{CURRENT}.{uuid.uuid4().hex}")
    out = system.create(ready)
    out.write(f"{version}\n".encode())
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
    files.rename(system.makeQualified(ready), system.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{path}/{CURRENT}")), overwrite)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None, keep: int = 1) -> str:
    """Replace the table at ``path`` as a whole; returns the folder of the new version. ``df`` may read the table itself.

    ``keep`` versions before the new one stay for those who still read them. If the write fails, the version in use stays in use
    and what was written of the new one is deleted.
    """
    spark = df.sparkSession
    version = f"version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    try:
        write_table(df, f"{path}/{version}", partition_by)
    except Exception:
        discard(spark, [f"{path}/{version}"])
        raise
    _switch(spark, path, version)
    before = [v for v in versions(spark, path) if v < version]
    discard(spark, [f"{path}/{v}" for v in before[: max(0, len(before) - keep)]])
    return f"{path}/{version}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, in the version now in use."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(as_path(f"{path}/{version}"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def catalog_name(table: str) -> str:
    """A name that the catalog takes: letters, digits and underscores."""
    return re.sub(r"\W", "_", table, flags=re.ASCII)


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Let ``name`` (``table`` or ``schema.table``) mean the version now in use of the table at ``path``."""
    files = as_path(f"{path}/{current_version(spark, path)}")
    columns = ", ".join(_quoted(c) for c in spark.read.parquet(files).columns)
    spark.sql(f"CREATE OR REPLACE VIEW {'.'.join(map(_quoted, name.split('.')))} AS SELECT {columns} FROM parquet.{_quoted(files)}")


def save_as_table(df: DataFrame, name: str, path: str, partition_by: list[str] | None = None, keep: int = 1) -> DataFrame:
    """Replace the table at ``path`` and let ``name`` mean it in the catalog; returns the new version.

    The name is bound to a version and is switched after its files are complete. A query that was planned before goes on to read the version before.
    """
    spark = df.sparkSession
    replace_table(df, path, partition_by, keep)
    register_table(spark, name, path)
    return read_table(spark, path)


def table_saver(spark: SparkSession, root: str, schema: str | None = None, keep: int = 1) -> Callable[[DataFrame, str], DataFrame]:
    """How :func:`landing.ingest_folder` stores a table: below ``root``, replaced as a whole, under its name in the catalog.
    Two tables whose names are the same in the catalog are an error."""
    owners: dict[str, str] = {}

    def save(df: DataFrame, table: str) -> DataFrame:
        name = catalog_name(table)
        if owners.setdefault(name.lower(), table) != table:
            raise ValueError(f"{table} and {owners[name.lower()]} have the same name in the catalog")
        return save_as_table(df, f"{schema}.{name}" if schema else name, f"{root}/{name}", [], keep)

    return save


def guarded_export(df: DataFrame, path: str, max_rows: int | None = None) -> int:
    """Write a selection as CSV; returns its rows, which are counted while they are written.

    With ``max_rows`` (an interactive export passes ``EXPORT_MAX_ROWS``) the selection is counted first, which reads the columns of its
    filters only, and a larger one is refused before anything is written or stored.
    """
    rows = df.count() if max_rows is not None else 0
    if max_rows is not None and rows > max_rows:
        raise ExportTooLarge(f"the selection has {rows} rows, more than {max_rows}; filter it further")
    written = Observation()
    write_csv(df.observe(written, F.count(F.lit(1)).alias("rows")), path)
    return written.get["rows"]


def export_report(df: DataFrame, path: str, max_rows: int = EXPORT_MAX_ROWS) -> DataFrame:
    """The outcome of a guarded export as a row: (status, rows, max_rows), the status ``written`` or ``refused``."""
    try:
        status, rows = "written", guarded_export(df, path, max_rows)
    except ExportTooLarge:
        status, rows = "refused", df.count()
    return df.sparkSession.createDataFrame([(status, rows, max_rows)], "status string, rows bigint, max_rows bigint")
