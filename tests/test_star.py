"""Raw sources over star tables of their own rows: nulls, repeated keys, orders and lines that meet nothing."""

import random
import re
from collections import Counter

import duckdb
import pytest

from epiweave.catalog import queries
from epiweave.sources import star

SOURCES = {"vigilancia": star.raw_surveillance, "clima": star.raw_climate, "aire": star.raw_air}
STATEMENTS = {"vigilancia": star.SURVEILLANCE, "clima": star.CLIMATE, "aire": star.AIR}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at, draw = tmp_path_factory.mktemp("star"), random.Random(4)
    some = lambda n: draw.choice([None, *range(n)])
    day = lambda: f"{draw.randint(1995, 1997)}-{draw.randint(1, 12):02d}-{draw.randint(1, 28):02d}"
    tables = {
        "nation": ([(i, f"NATION_{i}", i % 5) for i in range(8)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(i % 25, some(9), draw.choice(["BUILDING", "FURNITURE", None])) for i in range(30)], "c_custkey bigint, c_nationkey int, c_mktsegment string"),
        "part": ([(i % 15, draw.choice(["ECONOMY", "PROMO", "LARGE", None])) for i in range(18)], "p_partkey bigint, p_type string"),
        "orders": ([(some(70), some(30), day()) for _ in range(90)], "o_orderkey bigint, o_custkey bigint, o_orderdate string"),
        "lineitem": ([
            (some(75), some(17), draw.randint(1, 6), draw.choice([None, 3.0, 9.0]), 250.0, 0.03, 0.02, draw.choice("ANR"), draw.choice("OF"), day()) for _ in range(400)
        ], "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
           "l_returnflag string, l_linestatus string, l_shipdate string"),
    }
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        df = df.withColumns({c: df[c].cast("timestamp") for c in df.columns if c.endswith("date")})
        df.repartition(1).write.parquet(f"{at}/{name}.parquet")
    return str(at)


def sql(folder, statement):
    con = duckdb.connect()
    for table in ("nation", "customer", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    return con.execute(statement.format(**{t: t for t in star.TABLES})).fetchall()


def bag(rows):
    return Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)


@pytest.mark.parametrize("task_lines", [star.TASK_LINES, 20])
@pytest.mark.parametrize("source", list(SOURCES))
def test_sources_have_the_rows_of_their_statements(spark, folder, monkeypatch, source, task_lines):
    monkeypatch.setattr(star, "TASK_LINES", task_lines)
    found = bag(SOURCES[source](spark, folder).collect())
    assert found == bag(sql(folder, STATEMENTS[source])) and len(found) > 20


@pytest.mark.parametrize("source", list(SOURCES))
def test_lines_are_shuffled_while_narrow(spark, folder, monkeypatch, source):
    """Without broadcasts, lines go through one exchange, or two with parts, before they have an order's columns, and many lines are many tasks."""
    monkeypatch.setattr(star, "TASK_LINES", 20)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = SOURCES[source](spark, folder)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert re.search(r"hashpartitioning\(l_orderkey#\d+L?, 20\)", plan)
    before_nation = plan.index("[c_nationkey")
    assert not re.search(r"hashpartitioning\(l_partkey", plan[before_nation : plan.index("[l_orderkey", before_nation)])
    lines = plan[plan.index("hashpartitioning(o_orderkey") :]
    assert "hashpartitioning(o_custkey" in lines


def test_quality_report_counts_the_number_of_cases_as_a_key(spark, folder):
    got = {r.check_name: r.value for r in queries.REGISTRY["key_quality_report"](spark, folder).collect()}

    def number(text):
        return None if text in (None, "ND") else float(text)

    rows = [(*r[:5], number(r[5])) for r in sql(folder, star.SURVEILLANCE)]
    keys = ["ano", "semana", "departamento_ocurrencia", "municipio_ocurrencia", "nombre_evento", "conteo"]
    nulls = {f"nulls_{k}": sum(r[i] is None for r in rows) for i, k in enumerate(keys)}
    assert got == {"rows": len(rows), "duplicates": len(rows) - len(set(rows)), **nulls} and nulls["nulls_conteo"] > 0
