import random

import pytest
from pyspark.sql import functions as F

from epiweave.operators import paging
from epiweave.operators.quality import key_quality_report
from epiweave.plans import records


def rows():
    rng = random.Random(8)
    return [(rng.choice([None, *range(6)]), rng.choice([None, "a", "b", "ñ"]), i % 7) for i in range(300)] + [(3, "b", 1)] * 200


def in_order(found):
    return sorted(found, key=lambda r: [(v is None, 0 if v is None else v) for v in r])


@pytest.fixture(scope="module")
def index(spark):
    return paging.build_index(spark.createDataFrame(rows(), "k int, t string, n int").repartition(5), ["k", "t"], rows_per_range=40)


def test_pages_of_an_index(index):
    want = in_order(rows())
    for offset, limit in ((0, 5), (0, 500), (37, 10), (120, 90), (320, 30), (499, 10), (500, 5), (9999, 5), (-4, 0)):
        low = max(0, offset)
        assert [tuple(r) for r in index.page(offset, limit).collect()] == want[low : low + max(1, limit)], (offset, limit)
    with pytest.raises(ValueError, match="at most 50"):
        index.page(0, 51, max_rows=50)


def test_pages_of_a_condition(index):
    want = in_order([r for r in rows() if r[2] == 1])
    for offset, limit in ((0, 7), (30, 20), (200, 50), (len(want) - 1, 3), (len(want), 3)):
        assert [tuple(r) for r in index.page(offset, limit, F.col("n") == 1).collect()] == want[offset : offset + limit]
    assert index.page(0, 3, F.col("n") > 100).count() == 0


def test_an_index_is_split_evenly_and_read_in_part(index):
    """Two hundred equal rows are split like others, and a page touches the ranges that it lies in only."""
    sizes = [r.rows for r in index.ranges.orderBy("_range").collect()]
    assert sum(sizes) == 500 and len(sizes) > 8 and max(sizes) < 130
    firsts = [r["first"] for r in index.ranges.orderBy("_range").collect()]
    keys = [(f["k"]["last"], f["k"]["value"] or 0) for f in firsts]
    assert keys == sorted(keys)
    plan = index.page(sum(sizes[:4]), 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_range" in plan and "= 4" in plan


def test_the_number_of_ranges_is_limited(spark):
    """Ranges of a large table are larger instead of more, and a page still reads its own positions only."""
    stored = paging.materialize(paging.index_rows(spark.createDataFrame(rows(), "k int, t string, n int").repartition(5), ["k", "t"], 1, 6), "page-rows", ["_range"])
    index = paging.PageIndex(stored, paging.index_ranges(stored, ["k", "t"]), ["k", "t", "n"])
    sizes = [r.rows for r in index.ranges.orderBy("_range").collect()]
    assert sum(sizes) == 500 and len(sizes) <= 6
    want = in_order(rows())
    for offset, limit in ((0, 5), (37, 10), (sizes[0] - 3, 7), (0, 500), (499, 10), (500, 5)):
        assert [tuple(r) for r in index.page(offset, limit).collect()] == want[offset : offset + limit], (offset, limit)
    held = index.page(sizes[0] + 4, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "_at" in held and "< 7" in held
    assert [tuple(r) for r in index.page(5, 9, "n = 1").collect()] == [r for r in want if r[2] == 1][5:14]


def test_an_empty_index(spark):
    empty = paging.build_index(spark.createDataFrame([], "k int, t string"), ["k"])
    assert empty.page().count() == 0
    assert records.page_record(empty).first().payload == '{"columns":["k","t"],"rows":[],"offset":0,"limit":100,"filtered_total":0}'


def test_page_record(index):
    first = in_order(rows())[2:4]
    cells = ",".join('{"k":%s,"t":%s,"n":%d}' % (r[0], f'"{r[1]}"' if r[1] else "null", r[2]) for r in first)
    assert records.page_record(index, 2, 2).first().payload == f'{{"columns":["k","t","n"],"rows":[{cells}],"offset":2,"limit":2,"filtered_total":500}}'


def test_key_report_on_keys_only(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (None, "a", 5), (None, "a", 7), (2, None, 5)], "ano int, t string, conteo int")
    got = {r.check_name: r.value for r in key_quality_report(df, ["ano", "t", "absent"]).collect()}
    assert got == {"rows": 5, "nulls_ano": 2, "nulls_t": 1, "duplicates": 2}
