import pytest
from pyspark.sql import functions as F

from epiweave.operators import analytics, filters, forecast, label, paging, quality, reshape
from epiweave.plans import summary
from epiweave.schemas import MASTER_KEYS

COLUMNS = "ano int, semana int, departamento string, municipio string, enfermedad string, casos_totales bigint, brote string"


def master(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture
def table(spark):
    return master(spark, [
        (2020, 1, "A", "a", "DENGUE", 10, "SI"), (2020, 2, "A", "a", "DENGUE", 4, "NO"),
        (2021, 1, "B", "b", "ZIKA", 7, "NO"), (2021, 1, None, "c", "DENGUE", 30, "SI"),
        (2021, 2, "B", "b", "MALARIA", None, "NO"),
    ])


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_totals(table):
    assert rows(analytics.kpi_totals(table)) == [(5, 51, 3)]
    assert rows(analytics.disease_stats(table)) == [("DENGUE", 44, 3), ("ZIKA", 7, 1), ("MALARIA", 0, 1)]
    assert rows(analytics.outbreak_distribution(table)) == [("NO", 3), ("SI", 2)]
    assert rows(analytics.kpi_totals(table.limit(0))) == [(0, 0, 0)]


def test_variation(spark, table):
    assert rows(analytics.yearly_variation(table)) == [(2020, 2021, 14, 37, 164.3, "sube")]
    zero = master(spark, [(2020, 1, "A", "a", "D", 0, "NO"), (2022, 1, "A", "a", "D", 5, "NO")])
    assert rows(analytics.yearly_variation(zero)) == [(2020, 2022, 0, 5, None, "sube")]
    assert rows(analytics.yearly_variation(zero.where("ano = 2020"))) == []


def test_geo_pivot_and_fallback(table):
    got = rows(analytics.geo_pivot(table))
    assert got == [("A", 14, 14, 0, 0), ("B", 7, 0, 7, 0)]
    others = table.where("enfermedad = 'MALARIA'")
    assert rows(analytics.geo_pivot(others)) == [("B", 0, 0, 0, 0)]
    shares = {r.departamento: r.share for r in analytics.geo_share_of_max(others).collect()}
    assert shares == {"B": 0.0}


def test_trend_fills_years(table):
    got = sorted(rows(analytics.trend_top(table, 2)))
    assert got == [("DENGUE", 2020, 14), ("DENGUE", 2021, 30), ("ZIKA", 2020, 0), ("ZIKA", 2021, 7)]


def test_growth_and_comparison(spark, table):
    assert rows(analytics.fastest_growing(table)) == [("DENGUE", 114.3, 2020, 2021)]
    got = {r.enfermedad: r for r in analytics.compare_categories(table, ["DENGUE", "ZIKA"]).collect()}
    assert set(got) == {"DENGUE", "ZIKA"}
    assert (got["DENGUE"].casos, got["DENGUE"].pct, got["DENGUE"].direction) == (44, 114.3, "sube")
    assert (got["ZIKA"].top_departamento, got["ZIKA"].pct, got["ZIKA"].direction) == ("B", None, None)
    with pytest.raises(ValueError):
        analytics.compare_categories(table, ["DENGUE"])


def test_weekly_tail_and_facets(spark, table):
    assert [r.label for r in analytics.weekly_cases(table, 2).collect()] == ["2021-W01", "2021-W02"]
    facets = rows(analytics.facet_values(table))
    assert ("departamento", "A") in facets and ("ano", "2020") in facets and all(v for _, v in facets)


def test_forecast_wraps_the_year(spark):
    df = master(spark, [(2023, w, "A", "a", "D", 10 * w, "NO") for w in (49, 50, 51)] + [(2023, 53, "A", "a", "D", 9999, "NO")])
    got = rows(forecast.forecast_weeks(df).select("label", "casos").orderBy("ano", "semana"))
    assert got == [("2023-W52", 520), ("2024-W01", 530), ("2024-W02", 540), ("2024-W03", 550)]


def test_forecast_never_negative_and_short_history(spark):
    falling = master(spark, [(2023, 1, "A", "a", "D", 100, "NO"), (2023, 2, "A", "a", "D", 10, "NO")])
    assert [r.casos for r in forecast.forecast_weeks(falling).collect()] == [0, 0, 0, 0]
    single = falling.where("semana = 2")
    assert [r.casos for r in forecast.forecast_weeks(single).collect()] == [10, 10, 10, 10]
    assert forecast.forecast_weeks(single.limit(0)).count() == 0


def test_shift_week(spark):
    df = spark.range(1).select(*reshape.shift_week(F.lit(2023), F.lit(51), 2))
    assert rows(df) == [(2024, 1)]


def test_label(spark):
    base = master(spark, [(2020, w, "A", "a", "D", w, None) for w in range(1, 9)]).drop("brote")
    got = {r.semana: r.brote for r in label.outbreak_label(base).collect()}
    assert got == {w: "SI" if w > 6 else "NO" for w in range(1, 9)}
    empty = base.withColumn("casos_totales", F.lit(None).cast("bigint"))
    assert {r.brote for r in label.outbreak_label(empty).collect()} == {"NO"}


def test_quality(spark):
    df = spark.createDataFrame([(45.0, 1), (45.1, 1), (None, 1), (20.0, None), (20.0, None)], "t double, k int")
    ranges = {"t": (0, 45)}
    assert quality.sanity_filters(df, ranges).count() == 3
    assert dict(rows(quality.sanity_rejects(df, ranges))) == {"t": 2, "any_rule": 2}
    assert {r.column_name: (r.nulls, r.pct) for r in quality.null_audit(df).collect()} == {"t": (1, 20.0), "k": (2, 40.0)}
    report = dict(rows(quality.key_quality_report(df, ["t", "k"])))
    assert report == {"rows": 5, "nulls_t": 1, "nulls_k": 2, "duplicates": 1}
    assert dict(rows(quality.key_quality_report(df.limit(0), ["t"]))) == {"rows": 0, "nulls_t": 0, "duplicates": 0}
    assert quality.drop_incomplete(df).count() == 2 and quality.dedupe_rows(df).count() == 4


def test_months_and_weeks(spark):
    weeks = reshape.month_weeks()
    assert [w for _, w in weeks] == list(range(1, 53))
    assert [w for m, w in weeks if m == "dic"] == list(range(45, 53))
    wide = spark.createDataFrame([tuple([1] + list(range(1, 13)))], "id int, " + ", ".join(f"{m} int" for m in reshape.MONTHS))
    long = reshape.unpivot_months(wide, ["id"])
    back = reshape.pivot_mean(long, ["id"], "month_name", reshape.MONTHS, "valor")
    assert rows(back) == [tuple([1] + [float(i) for i in range(1, 13)])]
    assert sorted(r.semana for r in reshape.expand_weeks(spark.createDataFrame([(2020,)], "ano int")).collect()) == list(range(1, 53))


def test_filters(spark, table):
    keyed = filters.with_match_keys(table, ["departamento", "enfermedad", "municipio", "brote"])
    spec = filters.FilterSpec(q="dengue", enfermedad=["Dengué"], brote="sí", ano_max=2021)
    for source in (table, keyed):
        assert filters.apply_filters(source, spec).count() == 2
    assert filters.apply_filters(table, filters.FilterSpec()).count() == 5
    assert filters.apply_filters(table.drop("brote"), filters.FilterSpec(brote="SI")).count() == 5
    assert filters.search_text(table, "^a$").count() == 2
    assert filters.search_text(table, "^a$", literal=True).count() == 0
    assert filters.filter_years(table, ano=2020, semana=2).count() == 1
    with pytest.raises(TypeError):
        filters.FilterSpec(ano="2020")
    with pytest.raises(Exception):
        filters.FilterSpec(q="(")


def test_filter_order_does_not_matter(table):
    a = filters.filter_years(filters.filter_set_normalized(table, "enfermedad", ["dengue"]), ano_min=2021)
    b = filters.filter_set_normalized(filters.filter_years(table, ano_min=2021), "enfermedad", ["dengue"])
    assert rows(a) == rows(b)


def test_year_filter_prunes_partitions(spark, table):
    from epiweave.session import materialize

    stored = materialize(table, "prune", ["ano"])
    plan = filters.filter_years(stored, ano_min=2021)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan


@pytest.mark.parametrize("offset,limit", [(0, 3), (2, 2), (4, 10), (5, 10), (-3, 0)])
def test_pages_agree(table, offset, limit):
    shallow = rows(paging.page_rows(table, MASTER_KEYS, offset, limit))
    deep = rows(paging.page_rows(table, MASTER_KEYS, offset, limit, shallow=0))
    ordered = rows(table.orderBy(*[F.col(k).asc_nulls_last() for k in MASTER_KEYS]))
    assert shallow == deep == ordered[max(0, offset):max(0, offset) + max(1, limit)]


def test_summary_and_insights(table):
    facts = {(r.block, r.label): r.value for r in summary.summary_long(table, []).collect()}
    assert facts["kpi", "casos"] == 51 and facts["kpi", "municipios"] == 3
    assert facts["top_departamento", None] == 30 and facts["variacion", "sube"] == 164.3
    assert facts["tendencia", "2021|DENGUE"] == 30
    text = [r.text for r in summary.insights(table).orderBy("position").collect()]
    assert text[0] == "En el periodo 2020–2021, los casos subieron 164.3%."
    assert text[1].endswith("es DENGUE.")
    assert facts["tendencia", "2020|ZIKA"] == 0 and facts["tendencia", "2020|MALARIA"] == 0
    assert facts["variacion", "from_year"] == 2020 and facts["variacion", "to_cases"] == 37
    assert facts["frase", text[0]] == 1


def test_trend_ranks_by_rows_with_a_year(spark):
    table = master(spark, [(None, 1, "A", "a", "SIN ANO", 99, "NO")] + [(2020, 1, "A", "a", f"E{i}", i, "NO") for i in range(1, 6)])
    names = {r.label for r in summary.summary_long(table, []).where("block = 'tendencia'").collect()}
    assert names == {f"2020|E{i}" for i in range(1, 6)}


def test_filtered_page_has_the_total(table):
    spec = filters.FilterSpec(enfermedad=["DENGUE"])
    page, total = paging.filtered_page(table, spec, MASTER_KEYS, offset=1, limit=1)
    assert page.count() == 1 and total.first()[0] == 3
    beyond, total = paging.filtered_page(table, spec, MASTER_KEYS, offset=9, shallow=0)
    assert beyond.count() == 0 and total.first()[0] == 3
