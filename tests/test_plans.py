"""Plans over stored raw tables: where text rules run, and how hot keys are dealt."""

import random

import pytest
from pyspark.sql import functions as F

from epiweave.operators import joins, names, nearest
from epiweave.plans import conformed
from epiweave.session import materialize, stored_table
from epiweave.sources import star

SF_DIR = "/root/testdata/sf0.001"
RULES = ("regexp_replace", "translate", "upper(")


def below_first_exchange(df):
    """Plan lines between each scan of raw rows and the first exchange above it."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    for i, line in enumerate(lines):
        if "FileScan" in line:
            above = []
            for other in reversed(lines[:i]):
                if "Exchange" in other:
                    break
                above.append(other)
            yield above


@pytest.mark.parametrize("source,job", [
    (star.raw_surveillance, conformed.surveillance_weekly), (star.raw_climate, conformed.climate_weekly),
    (star.raw_air, conformed.air_quality_yearly), (star.raw_providers, conformed.providers_per_place),
])
def test_no_text_rule_before_the_first_exchange(spark, monkeypatch, source, job):
    raw = materialize(source(spark, SF_DIR), "raw")
    plans, store = [], conformed.materialize

    def stored(df, name):
        plans.append(df)
        return store(df, name)

    monkeypatch.setattr(conformed, "materialize", stored)
    plans.append(job(raw))
    for lines in below_first_exchange(plans[0]):  # what reads the raw table
        assert lines and not [line for line in lines for rule in RULES if rule in line]


def test_rules_run_once_per_spelling(spark):
    rows = spark.createDataFrame([(" Dengue", None, i) for i in range(500)] + [("x", "CALI", 1), (None, None, 2)], "a string, b string, n int")
    got = conformed.by_spelling(rows, ["a", "b"], [F.upper(F.trim("a")).alias("a"), F.concat("b", F.lit("!")).alias("c")])
    assert sorted(map(str, got.groupBy("a", "c").agg(F.sum("n").alias("n")).collect())) == sorted(
        ["Row(a='DENGUE', c=None, n=124750)", "Row(a='X', c='CALI!', n=1)", "Row(a=None, c=None, n=2)"]
    )


@pytest.fixture
def plain(spark):
    """Without adaptive execution and without broadcasts."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_hot_key_is_split(plain, how):
    many = plain.range(20_000).select(
        F.when(F.col("id") < 18_000, 7).when(F.col("id") < 19_000, F.lit(None)).otherwise(F.col("id") % 90).alias("k"), F.lit("a").alias("t"), "id"
    )
    few = plain.createDataFrame([(k, "a", k * 10) for k in range(60)] + [(7, "a", -1), (None, "a", 5)], "k long, t string, v long")
    want, got = many.join(few, ["k", "t"], how), joins.salted_join(many, few, ["k", "t"], how, hot_rows=500)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    split, whole = sizes(got), sizes(want)
    assert split[-1] < 2 * split[len(split) // 2] and whole[-1] > 5 * whole[len(whole) // 2]
    with pytest.raises(ValueError):
        joins.salted_join(many, few, ["k"], "outer")


@pytest.mark.parametrize("leaf_size", [512, 3])
def test_a_cell_that_holds_nearly_all_targets(plain, monkeypatch, leaf_size):
    draw = random.Random(4)
    schema = "departamento string, municipio string, latitud double, longitud double"
    targets = [("t", f"t{i}", draw.uniform(4.0, 4.02), draw.uniform(-74.02, -74.0)) for i in range(3000)]
    targets += [("u", f"u{i}", draw.uniform(-5, 15), draw.uniform(-82, -65)) for i in range(60)]
    refs = [("r", f"r{i}", draw.uniform(3.9, 4.1), draw.uniform(-74.1, -73.9)) for i in range(9)] + [("s", f"s{i}", draw.uniform(-5, 15), draw.uniform(-82, -65)) for i in range(40)]
    found, split = [], nearest.salted_join

    def salted_join(many, few, on, **options):
        found.append(split(many, few, on, **options))
        return found[-1]

    monkeypatch.setattr(nearest, "salted_join", salted_join)
    a, b = plain.createDataFrame(targets, schema), plain.createDataFrame(refs, schema)
    got = nearest.nearest_within(a, b, 50, leaf_size=leaf_size, hot_rows=200)
    rows = sorted(map(str, got.collect()))
    for pairs in found:
        parts = sizes(pairs)
        assert len(parts) >= 5 and parts[-1] < 3 * parts[len(parts) // 2]
    found.clear()
    assert rows == sorted(map(str, nearest.nearest_within(a, b, 50, leaf_size=leaf_size).collect()))
    parts = sizes(found[0])
    assert len(parts) < 8 or parts[-1] > 5 * parts[len(parts) // 2]


def test_a_hot_place_and_week(plain):
    fact = plain.range(5000).select(F.lit("d").alias("departamento"), F.when(F.col("id") < 4800, "m").otherwise(F.concat(F.lit("m"), F.col("id") % 40)).alias("municipio"), (F.col("id") % 2).cast("int").alias("semana"), "id")
    measures = plain.createDataFrame([("d", "m", 0, 1.0), ("d", "m1", 1, 2.0), ("d", "m2", 0, 3.0)], "departamento string, municipio string, semana int, v double")
    none = plain.createDataFrame([("d", "m3", "d", "m1", 2.0)], "target_dept string, target_muni string, ref_dept string, ref_muni string, dist_km double")
    got = joins.impute_from_neighbor(fact, none, measures, ["semana"], hot_rows=100)
    want = joins.impute_from_neighbor(fact, none, measures, ["semana"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    split = sizes(got)
    assert split[-1] < 3 * split[len(split) // 2]


def test_long_regions_cost_in_proportion(spark, monkeypatch):
    """A region of 100,000 characters is cut to the lengths that occur among the names only."""
    long_one = " ".join(f"w{i}" for i in range(16_000))
    known = spark.createDataFrame([(long_one,), ("VALLE DEL CAUCA",), ("CAUCA",)], "departamento string")
    wanted = ["w7000 w7001 w7002", "el valle del cauca (sur)", "cauca", "w123", "w15999", "absent name", long_one + " more"]
    counts, cut = [], names._pieces

    def pieces(*args):
        found = cut(*args)
        counts.append(found.count())
        return found

    monkeypatch.setattr(names, "_pieces", pieces)
    got = {r.nombre[:30]: (r.departamento and r.departamento[:20], r.how) for r in names.resolve_names(spark.createDataFrame([(w,) for w in wanted], "nombre string"), known).collect()}
    assert got["w7000 w7001 w7002"] == (long_one[:20], "contained") and got["el valle del cauca (sur)"] == ("VALLE DEL CAUCA", "contained")
    assert got["cauca"] == ("CAUCA", "exact") and got["absent name"] == (None, None) and got[long_one[:30]] == (long_one[:20], "contained")
    assert len(long_one) > 100_000 and sum(counts) < 5 * len(long_one)


def test_a_stored_table_follows_its_folder(spark, tmp_path):
    built = []

    def table():
        return stored_table(spark, "follows", str(tmp_path), lambda: (built.append(1), spark.read.parquet(f"{tmp_path}/t"))[1])

    spark.range(3).write.parquet(f"{tmp_path}/t")
    assert table().count() == table().count() == 3 and len(built) == 1
    spark.range(5).write.mode("overwrite").parquet(f"{tmp_path}/t")
    assert table().count() == 5 and len(built) == 2
