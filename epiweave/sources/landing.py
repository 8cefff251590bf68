"""Landing: pages of records as JSON files, and folders of CSV files into tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epiweave.fixed import SOURCE_PAGE_ROWS
from epiweave.functions.text import table_name
from epiweave.operators.cleaning import normalize_headers_landing
from epiweave.sources.readers import FALLBACK_ENCODING, as_path


def land_source(df: DataFrame, path: str) -> None:
    """Store a downloaded source with tidy headers."""
    normalize_headers_landing(df).write.mode("overwrite").parquet(path)


def land_json_pages(df: DataFrame, folder: str, page: str, page_rows: int = SOURCE_PAGE_ROWS, split: bool = False) -> None:
    """Write records as numbered page files, each a JSON array.

    ``page`` names the page-number column. No file, and so no array that a task gathers, holds more than ``page_rows`` records.
    Pages are counted first, and a larger one is an error; with ``split`` it goes into several files of the same number instead.
    """
    largest = 0 if split else df.groupBy(page).count().agg(F.max("count")).first()[0] or 0
    if largest > page_rows:
        raise ValueError(f"a page holds {largest} records, more than the page size {page_rows}")
    fields = [c for c in df.columns if c != page]
    position = F.row_number().over(Window.partitionBy(page).orderBy(page))
    parts = df.withColumn("part", ((position - 1) / page_rows).cast("int")).groupBy(page, "part")
    arrays = parts.agg(F.to_json(F.collect_list(F.struct(*fields)), {"ignoreNullFields": "false"}).alias("value"))
    files = arrays.select(F.format_string("page-%06d", F.col(page)).alias("page_file"), "part", "value")
    files.write.mode("overwrite").partitionBy("page_file", "part").text(folder)


def landed_files(spark: SparkSession, folder: str) -> list[tuple[str, str, int]]:
    """(name, path, bytes) of the CSV files of a folder, not of folders below it, by name.

    A folder called like a file, as Spark writes one, counts as one file. Only names are read.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(conf)
    entries = []
    for status in system.listStatus(place):
        path = status.getPath()
        if path.getName().lower().endswith(".csv"):
            entries.append((path.getName(), path.toString(), system.getContentSummary(path).getLength()))
    return sorted(entries)


def _load(spark: SparkSession, path: str, size: int, name: str, save: Callable[[DataFrame, str], DataFrame]) -> tuple[str, int | None, int | None]:
    if not size:
        return "error: empty file", None, None
    try:
        valid = spark.read.text(as_path(path)).agg(F.bool_and(F.is_valid_utf8("value"))).first()[0]
        encoding = "UTF-8" if valid else FALLBACK_ENCODING
        options = dict(header=True, encoding=encoding, escape='"')
        # the header alone is read by line: reading it with line breaks in cells can't take a literal path
        header = spark.read.options(**options).csv(as_path(path)).schema
        if not header.fields:
            raise ValueError("no header row")
        stored = save(spark.read.schema(header).options(**options, multiLine=True).csv(as_path(path)), name)
        return "ok", stored.count(), len(stored.columns)
    except Exception as error:
        return f"error: {type(error).__name__}", None, None


def ingest_folder(
    spark: SparkSession, folder: str, save: Callable[[DataFrame, str], DataFrame], at_once: int = 4
) -> DataFrame:
    """Load every CSV file of a folder into a table of its own; ``at_once`` files at a time.

    ``save(df, table)`` stores one table and returns it, so that rows are counted where counting
    is cheap. Returns (file, table_name, status, rows, columns), one row per file. A file that fails or is
    empty is reported and skipped. Files whose names give the same table are found before
    anything is written, and none of them is loaded. Values stay text, as landed.
    """
    files = landed_files(spark, folder)
    named = Counter(table_name(name) for name, _, _ in files)

    def one(file: tuple[str, str, int]) -> tuple:
        name, path, size = file
        table = table_name(name)
        result = ("error: name collision", None, None) if named[table] > 1 else _load(spark, path, size, table, save)
        return (name, table, *result)

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        report = list(pool.map(one, files))
    return spark.createDataFrame(report, "file string, table_name string, status string, rows bigint, columns int")
