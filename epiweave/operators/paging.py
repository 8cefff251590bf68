"""Pages of rows in a fixed order: by top-k, by seeking through counts, or by an index of positions that is stored once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epiweave.fixed import PAGE_MAX_ROWS
from epiweave.operators.filters import FilterSpec, apply_filters
from epiweave.session import materialize

# Up to this many rows are ranked by Spark's top-k (each task keeps offset + limit rows).
SHALLOW_ROWS = 100_000
# Rows of a range of an index: what a page reads, besides the list of ranges.
RANGE_ROWS = 100_000
# Most ranges of an index: each is a task and a folder, and the driver holds the list of them. A larger table has larger ranges.
MOST_RANGES = 1024
# Columns of stored index rows besides their own: range, position in it, and what tells equal rows apart.
INDEX_COLUMNS = ("_range", "_at", "_tie")


@dataclass(frozen=True)
class PageIndex:
    """Rows stored in ranges of a fixed order. ``ranges`` has a row for each range: ``_range``, ``rows``, and the first key in it."""

    rows: DataFrame
    ranges: DataFrame
    order: list[str]

    def page(self, offset: int = 0, limit: int = 100, where: Column | str | None = None, max_rows: int = PAGE_MAX_ROWS) -> DataFrame:
        """Rows ``offset`` to ``offset + limit``, of those that fulfil ``where``.

        Without a condition a page reads the list of ranges and its own positions in the one or two ranges that it lies in. With one,
        the rows that fulfil it are counted range by range first, which reads the columns of the condition only.
        """
        offset, limit = _bounds(offset, limit, max_rows)
        chosen = self.rows if where is None else self.rows.where(where)
        counts = self.ranges.select("_range", "rows") if where is None else chosen.groupBy("_range").agg(F.count("*").alias("rows"))
        hit, skip, stop, before = [], 0, 0, 0
        for part, rows in sorted(counts.collect()):
            if before < offset + limit and before + rows > offset:
                skip = skip if hit else offset - before
                stop = offset + limit - before
                hit.append(part)
            before += rows
        ordering = [F.col(c).asc_nulls_last() for c in [*self.order, "_tie"]]
        found = chosen.where(F.col("_range").isin(hit)) if hit else chosen.limit(0)
        if where is None and hit:  # files are sorted by position, so only those pages of them are read
            first, last = F.col("_at") >= skip, F.col("_at") < stop
            found = found.where(first & last if len(hit) == 1 else ((F.col("_range") > hit[0]) | first) & ((F.col("_range") < hit[-1]) | last))
            skip = 0
        return found.orderBy(*ordering).offset(skip).limit(limit).drop(*INDEX_COLUMNS)


def _bounds(offset: int, limit: int, max_rows: int) -> tuple[int, int]:
    if limit > max_rows:
        raise ValueError(f"a page has at most {max_rows} rows, {limit} were asked for")
    return max(0, offset), max(1, limit)


def index_rows(df: DataFrame, keys: list[str], rows_per_range: int = RANGE_ROWS, most_ranges: int = MOST_RANGES) -> DataFrame:
    """Rows dealt out in ranges of the order by ``keys`` (nulls last) and the remaining columns, each range sorted. ``_tie`` tells equal
    rows apart, so that any number of them is split over ranges like others; ``_at`` is a row's position in its range.

    Ranges have about ``rows_per_range`` rows, and more where there would be over ``most_ranges`` of them."""
    order = [*keys, *(c for c in df.columns if c not in keys)]
    ranges = min(max(1, -(-df.count() // rows_per_range)), most_ranges)
    ordering = [F.col(c).asc_nulls_last() for c in [*order, "_tie"]]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(ranges, *ordering)
    ordered = dealt.withColumn("_range", F.spark_partition_id()).sortWithinPartitions("_range", *ordering)
    return ordered.withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))


def index_ranges(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(_range, rows, first) of each range of stored index rows; ``first`` holds its first values of the keys."""
    first = F.struct(*[F.struct(F.col(k).isNull().alias("last"), F.col(k).alias("value")).alias(k) for k in keys])
    return rows.groupBy("_range").agg(F.count("*").alias("rows"), F.min(first).alias("first"))


def build_index(df: DataFrame, keys: list[str], rows_per_range: int = RANGE_ROWS) -> PageIndex:
    """Store the rows of ``df`` for paging by ``keys``: once, for all pages."""
    rows = materialize(index_rows(df, keys, rows_per_range), "page-rows", ["_range"])
    return PageIndex(rows, materialize(index_ranges(rows, keys), "page-ranges"), [*keys, *(c for c in df.columns if c not in keys)])


def _is(name: str, value) -> Column:
    return F.col(name).eqNullSafe(F.lit(value))


def _after(name: str, value) -> Column:
    """Sorted after ``value``, with nulls last."""
    if value is None:
        return F.lit(False)
    return F.col(name).isNull() | (F.col(name) > F.lit(value))


def _locate(df: DataFrame, keys: list[str], offset: int) -> tuple[list, int] | None:
    """Key of the row at position ``offset``, and how many equal keys precede it.

    One step per key column: count the rows per value under the prefix found so far and keep the
    value whose running count passes the offset. Values are dealt out by range, so a running count
    goes through the values of one range only; of the others just the sums are looked at.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    prefix: list = []
    for key in keys:
        place = F.col(key).asc_nulls_last()
        counts = materialize(
            df.groupBy(key).count().repartitionByRange(ranges, place).withColumn("_range", F.spark_partition_id()), "page-counts"
        )
        for part, rows in sorted(counts.groupBy("_range").agg(F.sum("count")).collect()):
            if rows > offset:
                break
            offset -= rows
        else:
            return None
        hit = (
            counts.where(F.col("_range") == part)
            .withColumn("upto", F.sum("count").over(Window.partitionBy("_range").orderBy(place)))
            .where(F.col("upto") > offset).orderBy("upto").limit(1).first()
        )
        offset -= hit["upto"] - hit["count"]
        prefix.append(hit[key])
        df = df.where(_is(key, hit[key]))
    return prefix, offset


def page_rows(
    df: DataFrame, keys: list[str], offset: int = 0, limit: int = 100, shallow: int = SHALLOW_ROWS,
    max_rows: int = PAGE_MAX_ROWS,
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` ordered by ``keys``, nulls last.

    A limit below 1 counts as 1, one above ``max_rows`` is an error, and a negative offset counts as 0. A deep page is found by
    seeking to the key at the offset, so no task ever ranks the rows before the page; who wants many of them makes a
    :class:`PageIndex`. ``keys`` should be unique; rows that share a key are ordered by the remaining columns.
    """
    offset, limit = _bounds(offset, limit, max_rows)
    order = keys + [c for c in df.columns if c not in keys]
    ordering = [F.col(c).asc_nulls_last() for c in order]
    if offset + limit > shallow:
        found = _locate(df, keys, offset)
        if found is None:
            return df.limit(0)
        prefix, offset = found
        tests = [
            reduce(lambda a, b: a & b, [_is(k, v) for k, v in zip(keys[:i], prefix[:i])], _after(keys[i], prefix[i]))
            for i in range(len(keys))
        ]
        at_key = reduce(lambda a, b: a & b, [_is(k, v) for k, v in zip(keys, prefix)])
        df = df.where(reduce(lambda a, b: a | b, tests, at_key))
    return df.orderBy(*ordering).offset(offset).limit(limit)


def filtered_page(
    df: DataFrame, spec: FilterSpec, keys: list[str], offset: int = 0, limit: int = 100, shallow: int = SHALLOW_ROWS,
    max_rows: int = PAGE_MAX_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(page, total) of a selection: its rows as :func:`page_rows` gives them, and one row ``filtered_total``, the number of all its rows."""
    chosen = apply_filters(df, spec)
    return page_rows(chosen, keys, offset, limit, shallow, max_rows), chosen.agg(F.count("*").alias("filtered_total"))
