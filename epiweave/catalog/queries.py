"""Registered queries: one per operator, each over the whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiweave import fixed, schemas, sinks
from epiweave.catalog import tables
from epiweave.functions.text import harmonize, match_key, normalize_text
from epiweave.operators import analytics, cleaning, conversations, filters, forecast, joins, label, names
from epiweave.operators import nearest, paging, quality, reshape
from epiweave.plans import conformed, master, records, summary
from epiweave.session import work_path
from epiweave.sources import landing, readers, star

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
PLACE = joins.PLACE


def query(function: Query) -> Query:
    """Register a query under its function's name (a trailing underscore avoids an import)."""
    REGISTRY[function.__name__.rstrip("_")] = function
    return function


def _counted(df: DataFrame, *more: str) -> DataFrame:
    """Show missing counts as 0, as the master table does."""
    return cleaning.fill_nulls(df, {c: 0 for c in ("casos_totales", *more)})


# ---- sources and sinks -------------------------------------------------------------------


@query
def scan_csv_roundtrip(spark, sf_dir):
    """Surveillance rows landed as CSV files of two layouts, and read by the header of each file with the explicit schema."""
    path = work_path(spark, "csv")
    raw = star.raw_surveillance(spark, sf_dir)
    later = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns]), F.lit(2)) == 1
    sinks.write_csv(cleaning.normalize_headers(raw.where(~later)), f"{path}/first")
    sinks.write_csv(raw.where(later).select(F.lit("sin uso").alias("Código"), *[F.col(f"`{c}`") for c in reversed(raw.columns)]), f"{path}/later")
    landed = readers.read_source(spark, path, schemas.SURVEILLANCE_RAW)
    return landed.groupBy(*landed.columns).agg(F.count("*").alias("filas"))


@query
def scan_encoding_fallback(spark, sf_dir):
    """Documents landed in two encodings by language, each with its own order of columns; the reader tells them apart."""
    docs = star.load(spark, sf_dir, "documents")
    folder = work_path(spark, "encodings")
    options = dict(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    latin = F.col("lang").isin("fr", "es")
    docs.where(latin).select(*reversed(docs.columns)).write.options(encoding=readers.FALLBACK_ENCODING, **options).csv(f"{folder}/latin")
    docs.where(~latin).write.options(encoding="UTF-8", **options).csv(f"{folder}/utf8")
    return readers.read_source_any_encoding(spark, folder, docs.schema, multi_line=True)


def _landed_pages(spark, sf_dir) -> tuple[str, DataFrame, int]:
    """Orders as pages of records: the fourth page is short, and the sixth has landed under a later number, which may be
    that of another page as well: the two are then files of one number."""
    rows = star.load(spark, sf_dir, "orders")
    folder, size = work_path(spark, "pages"), 2000
    page = F.expr(f"cast(o_orderkey div {size} as int)")
    page = F.when((page == 3) & (F.col("o_orderkey") % 2 == 0), 1000).when(page == 5, 1002).otherwise(page)
    landing.land_json_pages(rows.withColumn("page", page), folder, "page", size, split=True)
    return folder, rows, size


@query
def scan_json_pages(spark, sf_dir):
    """Orders landed as numbered pages of JSON records and read back, past a short page and gaps."""
    folder, rows, size = _landed_pages(spark, sf_dir)
    return readers.read_json_pages(spark, folder, rows.schema, size)


@query
def json_pages_report(spark, sf_dir):
    folder, rows, size = _landed_pages(spark, sf_dir)
    return readers.json_pages_report(spark, folder, rows.schema, size)


def _segment_files(spark, sf_dir, customers) -> str:
    folder = work_path(spark, "ingest")
    for (segment,) in customers.select("c_mktsegment").distinct().collect():
        part = customers.where(F.col("c_mktsegment").eqNullSafe(segment))
        sinks.write_csv(part, f"{folder}/Segmento-{segment or 'NINGUNO'} (2024).csv")
    return folder


@query
def ingest_folder_report(spark, sf_dir):
    """Customer files, one per market segment, loaded into a table each."""
    folder = _segment_files(spark, sf_dir, star.load(spark, sf_dir, "customer"))
    return landing.ingest_folder(spark, folder, sinks.table_saver(spark, work_path(spark, "lake")))


@query
def ingest_folder_tables(spark, sf_dir):
    """Tables by their catalog names after the folder has been ingested twice, and what a reader sees that began before the second time."""
    customers, save = star.load(spark, sf_dir, "customer"), sinks.table_saver(spark, work_path(spark, "lake"))
    halves = customers.where("c_custkey % 2 = 0")
    names = [r.table_name for r in landing.ingest_folder(spark, _segment_files(spark, sf_dir, halves), save).collect()]

    def sums(names: list[str], reader: str) -> list[DataFrame]:
        return [
            spark.table(n).agg(F.count("*").alias("filas"), F.sum(F.col("c_acctbal").cast("decimal(15,2)")).cast("double").alias("saldo"))
            .withColumns({"table_name": F.lit(n), "reader": F.lit(reader)}) for n in names
        ]

    before = sums(names, "before")
    names = [r.table_name for r in landing.ingest_folder(spark, _segment_files(spark, sf_dir, customers), save).collect()]
    return reduce(DataFrame.unionByName, before + sums(names, "after"))


@query
def replace_table(spark, sf_dir):
    """A table partitioned by year that is replaced by rows made from itself."""
    path = work_path(spark, "replaced")
    sinks.replace_table(tables.serving(spark, sf_dir), path)
    now = sinks.read_table(spark, path)
    sinks.replace_table(now.where("brote = 'SI'").withColumn("casos_totales", F.col("casos_totales") * 2), path)
    return sinks.read_table(spark, path).select(*schemas.MASTER.fieldNames())


@query
def table_meta(spark, sf_dir):
    return analytics.table_meta(tables.serving(spark, sf_dir))


@query
def sink_roundtrip_csv(spark, sf_dir):
    path = work_path(spark, "master-csv")
    sinks.write_csv(tables.serving(spark, sf_dir), path)
    return readers.read_source(spark, path, schemas.MASTER)


@query
def sink_roundtrip_parquet(spark, sf_dir):
    path = work_path(spark, "master-parquet")
    sinks.write_table(tables.serving(spark, sf_dir), path)
    return spark.read.parquet(path).select(*schemas.MASTER.fieldNames())


@query
def guarded_export(spark, sf_dir):
    """Export of one disease and later years, under the export limit."""
    path = work_path(spark, "export")
    chosen = filters.filter_years(tables.serving(spark, sf_dir), ano_min=1998)
    sinks.guarded_export(filters.filter_categories(chosen, "enfermedad", ["DENGUE"]), path, fixed.EXPORT_MAX_ROWS)
    return readers.read_source(spark, path, schemas.MASTER)


@query
def export_report(spark, sf_dir):
    """Two exports: all cases, and all readings repeated for every week of a year, which are too many."""
    cases = sinks.export_report(tables.cases(spark, sf_dir), work_path(spark, "export"))
    weekly = reshape.expand_weeks(star.view(spark, sf_dir, star.READINGS))
    readings = sinks.export_report(weekly, work_path(spark, "export"))
    return cases.withColumn("selection", F.lit("cases")).unionByName(readings.withColumn("selection", F.lit("weekly readings")))


# ---- projection and cleaning -------------------------------------------------------------


@query
def normalize_headers(spark, sf_dir):
    clean = cleaning.normalize_headers(star.raw_surveillance(spark, sf_dir))
    return clean.groupBy("ano", "nombre_evento").agg(
        F.count("conteo").alias("conteos"), F.count("municipio_ocurrencia").alias("municipios")
    )


@query
def normalize_headers_landing(spark, sf_dir):
    path = work_path(spark, "landed")
    raw = star.load(spark, sf_dir, "customer").toDF(" c:custkey", "c name", "c-nationkey ", "c acct:bal", "segment")
    landing.land_source(raw, path)
    return spark.read.parquet(path)


@query
def normalize_text_(spark, sf_dir):
    """Raw spellings of surveillance and climate places with their conformed form."""
    vig = cleaning.normalize_headers(star.raw_surveillance(spark, sf_dir))
    spelled = vig.groupBy("departamento_ocurrencia", "municipio_ocurrencia", "nombre_evento").agg(F.count("*").alias("filas"))
    return cleaning.normalize_text(
        spelled.withColumn("municipio_original", F.col("municipio_ocurrencia")),
        ["departamento_ocurrencia", "municipio_ocurrencia", "nombre_evento"],
    )


@query
def normalize_text_mangled(spark, sf_dir):
    clima = star.raw_climate(spark, sf_dir)
    return clima.select(
        F.col("municipio").alias("original"),
        normalize_text("departamento").alias("departamento"),
        normalize_text("municipio").alias("municipio"),
        normalize_text("par_metro").alias("par_metro"),
        "ao",
    )


@query
def match_key_(spark, sf_dir):
    """Comparison key of every document's whole text."""
    return star.load(spark, sf_dir, "documents").select("doc_id", match_key("text").alias("clave"))


@query
def harmonize_names(spark, sf_dir):
    vig = cleaning.normalize_headers(star.raw_surveillance(spark, sf_dir))
    spelled = vig.groupBy(F.col("departamento_ocurrencia").alias("original")).agg(F.count("*").alias("filas"))
    return spelled.select("original", "filas", harmonize(normalize_text("original")).alias("departamento"))


@query
def project_cast(spark, sf_dir):
    raw = cleaning.normalize_headers(star.raw_surveillance(spark, sf_dir))
    named = cleaning.rename(raw, {"departamento_ocurrencia": "departamento", "municipio_ocurrencia": "municipio"})
    typed = cleaning.project_cast(named, {
        "ano": ("ano", "int"), "semana": ("semana", "int"), "departamento": ("departamento", "string"),
        "municipio": ("municipio", "string"), "enfermedad": ("nombre_evento", "string"),
        "casos_totales": ("conteo", "int"),
    })
    return typed.groupBy("ano", "semana", "departamento", "enfermedad").agg(
        analytics.total("casos_totales").alias("casos"), F.count_if(F.col("casos_totales").isNull()).alias("sin_dato"),
        F.count_distinct("municipio").alias("municipios"),
    )


@query
def categorize_case(spark, sf_dir):
    """Both category rules: by membership on air variables, by substring on climate parameters."""
    aire = cleaning.normalize_headers(star.raw_air(spark, sf_dir))
    groups = {"calidad_aire": fixed.POLLUTANTS, "temperatura": fixed.AIR_TEMPERATURES}
    by_set = aire.select("variable", cleaning.category_by_membership("variable", groups).alias("grupo"))
    parameter = normalize_text("par_metro")
    by_part = star.raw_climate(spark, sf_dir).select(
        parameter.alias("variable"), cleaning.category_by_substring(parameter, fixed.CLIMATE_PARAMETERS).alias("grupo")
    )
    return by_set.unionByName(by_part).groupBy("variable", "grupo").agg(F.count("*").alias("filas"))


@query
def enforce_schema(spark, sf_dir):
    """Conformed cases under the master schema: the constant is set, absent columns are null."""
    base = cleaning.add_constant(tables.cases(spark, sf_dir), "vacunacion", fixed.VACCINATION_CONSTANT)
    return _counted(cleaning.enforce_schema(base, schemas.MASTER), "cantidad_hospitales")


@query
def join_key(spark, sf_dir):
    keyed = cleaning.add_join_key(tables.cases(spark, sf_dir), ["ano", "semana", *PLACE])
    return keyed.groupBy("join_key").agg(F.count("*").alias("filas"))


@query
def fill_nulls(spark, sf_dir):
    readings = star.view(spark, sf_dir, star.READINGS)
    filled = cleaning.fill_nulls(readings, {"temperatura_promedio": 0.0, "calidad_aire_promedio": -1.0})
    return filled.select("l_orderkey", "l_linenumber", "l_suppkey", "temperatura_promedio", "calidad_aire_promedio")


@query
def coalesce_sources(spark, sf_dir):
    readings = star.view(spark, sf_dir, star.READINGS)
    merged = cleaning.coalesce_sources(
        readings, {"temperatura_promedio": ["temperatura_promedio", "temperatura_promedio_aire"]}
    )
    return merged.select("l_orderkey", "l_linenumber", "l_suppkey", "temperatura_promedio")


@query
def round_metrics(spark, sf_dir):
    readings = star.view(spark, sf_dir, star.READINGS)
    return cleaning.round_metrics(readings, {"latitud": 2, "longitud": 1}).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "latitud", "longitud"
    )


# ---- filters and quality -----------------------------------------------------------------


@query
def filter_categories(spark, sf_dir):
    return _counted(filters.filter_categories(tables.cases(spark, sf_dir), "enfermedad", ["DENGUE", "ZIKA"]))


@query
def sanity_filters(spark, sf_dir):
    return quality.sanity_filters(star.view(spark, sf_dir, star.READINGS))


@query
def sanity_rejects(spark, sf_dir):
    return quality.sanity_rejects(star.view(spark, sf_dir, star.READINGS))


@query
def drop_incomplete(spark, sf_dir):
    return quality.drop_incomplete(tables.joined(spark, sf_dir))


@query
def dedupe_rows(spark, sf_dir):
    """Distinct raw surveillance rows."""
    return quality.dedupe_rows(cleaning.normalize_headers(star.raw_surveillance(spark, sf_dir)))


@query
def null_audit(spark, sf_dir):
    return quality.null_audit(tables.joined(spark, sf_dir))


@query
def key_quality_report(spark, sf_dir):
    """Keys of the raw surveillance rows, before duplicates are summed."""
    raw = cleaning.normalize_headers(star.raw_surveillance(spark, sf_dir))
    return quality.key_quality_report(
        raw.withColumn("conteo", F.col("conteo").try_cast("double")),
        ["ano", "semana", "departamento_ocurrencia", "municipio_ocurrencia", "nombre_evento", "conteo"],
    )


@query
def search_text(spark, sf_dir):
    """Regular-expression search."""
    return filters.search_text(tables.serving(spark, sf_dir), r"nation_\d1?.* auto|cartagena")


@query
def search_text_literal(spark, sf_dir):
    return filters.search_text(tables.serving(spark, sf_dir), "d.c.", literal=True)


@query
def filter_set_normalized(spark, sf_dir):
    chosen = ["Bogotá, D.C.", "la guajira", "San Andrés, Providencia y Santa Catalina"]
    kept = filters.filter_set_normalized(tables.serving_keyed(spark, sf_dir), "departamento", chosen)
    return kept.select(*schemas.MASTER.fieldNames())


@query
def filter_eq_normalized(spark, sf_dir):
    """Computed keys: the table without stored keys gives the same rows."""
    return filters.filter_eq_normalized(tables.serving(spark, sf_dir), "municipio", " nation 5-Building ")


@query
def filter_year_range(spark, sf_dir):
    return filters.filter_years(tables.serving(spark, sf_dir), ano_min=1996, ano_max=1998)


SELECTION = filters.FilterSpec(
    q="nation|santa", departamento=["Valle del Cauca", "norte de santander"], enfermedad=["dengue", "Zika"],
    brote="si", ano_min=1996, ano_max=2000,
)


@query
def filter_combined(spark, sf_dir):
    kept = filters.apply_filters(tables.serving_keyed(spark, sf_dir), SELECTION)
    return kept.select(*schemas.MASTER.fieldNames())


# ---- joins and geography -----------------------------------------------------------------


@query
def nearest_within_radius(spark, sf_dir):
    """Nearest supplier within 50 km of every customer."""
    found = nearest.nearest_within(
        star.view(spark, sf_dir, star.TARGET_POINTS), star.view(spark, sf_dir, star.REFERENCE_POINTS)
    )
    return found.withColumn("dist_km", F.round("dist_km", 6))


@query
def nearest_dense(spark, sf_dir):
    """Nearest other role at a wide radius, where grid cells are crowded: the nearest customer
    of every supplier within 500 km, with splitting forced by a small leaf."""
    found = nearest.nearest_within(
        star.view(spark, sf_dir, star.REFERENCE_POINTS), star.view(spark, sf_dir, star.TARGET_POINTS),
        max_km=500.0, leaf_size=16,
    )
    return found.withColumn("dist_km", F.round("dist_km", 6))


@query
def coordinate_reference(spark, sf_dir):
    return master.coordinate_reference(tables.climate(spark, sf_dir), tables.air(spark, sf_dir))


@query
def left_join_dims(spark, sf_dir):
    """Cases with coordinates and provider counts of their place."""
    return _counted(joins.left_join_dims(
        tables.cases(spark, sf_dir), [tables.geo(spark, sf_dir), tables.providers(spark, sf_dir)]
    ), "cantidad_hospitales")


def _maps(spark, sf_dir):
    return master.neighbor_maps(tables.sources(spark, sf_dir), tables.geo(spark, sf_dir))


@query
def neighbor_map(spark, sf_dir):
    """Climate and air neighbours of every surveillance place."""
    to_climate, to_air = _maps(spark, sf_dir)
    both = to_climate.withColumn("fuente", F.lit("clima")).unionByName(to_air.withColumn("fuente", F.lit("aire")))
    return both.withColumn("dist_km", F.round("dist_km", 6))


@query
def impute_from_neighbor_week(spark, sf_dir):
    climate = tables.climate(spark, sf_dir).drop("latitud", "longitud")
    cases = _counted(tables.cases(spark, sf_dir))
    filled = joins.impute_from_neighbor(cases, _maps(spark, sf_dir)[0], climate, ["semana"])
    return cleaning.round_metrics(filled, {"temperatura_promedio": 6, "precipitacion_promedio": 6})


@query
def impute_from_neighbor_year(spark, sf_dir):
    air = tables.air(spark, sf_dir).select("ano", *PLACE, "calidad_aire_promedio", "temperatura_promedio_aire")
    cases = _counted(tables.cases(spark, sf_dir))
    filled = joins.impute_from_neighbor(cases, _maps(spark, sf_dir)[1], air, ["ano"])
    return cleaning.round_metrics(filled, {"calidad_aire_promedio": 6, "temperatura_promedio_aire": 6})


@query
def resolve_region_names(spark, sf_dir):
    """Free region names of all customers against the regions of the cases."""
    free = star.view(spark, sf_dir, star.FREE_NAMES)
    resolved = names.resolve_names(free, tables.cases(spark, sf_dir).select("departamento").distinct())
    counted = free.groupBy("nombre").agg(F.count("*").alias("filas"))
    return counted.join(resolved, "nombre")


# ---- aggregates and labels ---------------------------------------------------------------


@query
def cases_by_key(spark, sf_dir):
    raw = cleaning.normalize_headers(star.raw_surveillance(spark, sf_dir))
    typed = cleaning.project_cast(raw, {
        "ano": ("ano", "int"), "semana": ("semana", "int"), "departamento": ("departamento_ocurrencia", "string"),
        "municipio": ("municipio_ocurrencia", "string"), "enfermedad": ("nombre_evento", "string"),
        "casos_totales": ("conteo", "int"),
    })
    return _counted(
        typed.groupBy("ano", "semana", *PLACE, "enfermedad").agg(F.sum("casos_totales").alias("casos_totales"))
    )


@query
def outbreak_threshold(spark, sf_dir):
    return label.outbreak_threshold(tables.cases(spark, sf_dir), ["enfermedad", "municipio"])


@query
def outbreak_label(spark, sf_dir):
    return label.outbreak_label(tables.cases(spark, sf_dir))


# ---- reshape and source jobs -------------------------------------------------------------


@query
def unpivot_months(spark, sf_dir):
    clima = star.raw_climate(spark, sf_dir)
    long = reshape.unpivot_months(clima, ["departamento", "municipio", "par_metro", "ao"])
    return cleaning.round_metrics(long, {"valor": 6})


@query
def month_to_week(spark, sf_dir):
    clima = star.raw_climate(spark, sf_dir)
    long = reshape.unpivot_months(clima, ["departamento", "municipio", "par_metro", "ao"])
    return cleaning.round_metrics(reshape.months_to_weeks(long), {"valor": 6})


@query
def pivot_parameters(spark, sf_dir):
    """Mean value per place, month and climate parameter, a column for each parameter."""
    clima = star.raw_climate(spark, sf_dir)
    kind = cleaning.category_by_substring(normalize_text("par_metro"), fixed.CLIMATE_PARAMETERS)
    long = reshape.unpivot_months(clima.withColumn("medida", kind), ["departamento", "municipio", "medida"])
    measures = list(fixed.CLIMATE_PARAMETERS.values())
    wide = reshape.pivot_mean(long.where(F.col("medida").isNotNull()), ["departamento", "municipio", "month_name"], "medida", measures, "valor")
    return cleaning.round_metrics(wide, {m: 6 for m in measures})


@query
def expand_weeks(spark, sf_dir):
    air = tables.air(spark, sf_dir)
    return reshape.expand_weeks(air.select("ano", *PLACE))


@query
def surveillance_weekly(spark, sf_dir):
    return _counted(conformed.surveillance_weekly(star.raw_surveillance(spark, sf_dir)))


@query
def climate_weekly(spark, sf_dir):
    clima = conformed.climate_weekly(star.raw_climate(spark, sf_dir))
    return cleaning.round_metrics(clima, {"temperatura_promedio": 6, "precipitacion_promedio": 6})


@query
def air_quality_yearly(spark, sf_dir):
    air = conformed.air_quality_yearly(star.raw_air(spark, sf_dir))
    return cleaning.round_metrics(air, {"calidad_aire_promedio": 6, "temperatura_promedio_aire": 6})


@query
def air_quality_weekly(spark, sf_dir):
    air = conformed.air_quality_weekly(star.raw_air(spark, sf_dir))
    return cleaning.round_metrics(air, {"calidad_aire_promedio": 6, "temperatura_promedio_aire": 6})


@query
def providers_per_place(spark, sf_dir):
    return conformed.providers_per_place(star.raw_providers(spark, sf_dir))


@query
def master_dataset(spark, sf_dir):
    """All four raw sources to the master table."""
    return master.master_dataset(
        star.raw_surveillance(spark, sf_dir), star.raw_climate(spark, sf_dir),
        star.raw_air(spark, sf_dir), star.raw_providers(spark, sf_dir),
    )


@query
def master_from_landed_csv(spark, sf_dir):
    """All four sources landed as CSV files with their own headers and a column more, read by name, to the master table."""
    landed = {
        "vigilancia": (star.raw_surveillance(spark, sf_dir), schemas.SURVEILLANCE_RAW), "clima": (star.raw_climate(spark, sf_dir), schemas.CLIMATE_RAW),
        "aire": (star.raw_air(spark, sf_dir), schemas.AIR_RAW), "prestadores": (star.raw_providers(spark, sf_dir), schemas.PROVIDERS_RAW),
    }
    folder, read = work_path(spark, "landed-csv"), []
    for name, (rows, schema) in landed.items():
        sinks.write_csv(rows.select(F.lit("sin uso").alias("Código"), *[F.col(f"`{c}`") for c in reversed(rows.columns)]), f"{folder}/{name}.csv")
        read.append(readers.read_source(spark, f"{folder}/{name}.csv", schema))
    return master.master_dataset(*read)


# ---- reports over the master table -------------------------------------------------------


def _report(name: str, function: Callable[[DataFrame], DataFrame]) -> None:
    REGISTRY[name] = lambda spark, sf_dir: function(tables.serving(spark, sf_dir))


for _name, _function in {
    "kpi_totals": analytics.kpi_totals,
    "outbreak_distribution": analytics.outbreak_distribution,
    "disease_stats": analytics.disease_stats,
    "metric_means": analytics.metric_means,
    "weekly_cases": analytics.weekly_cases,
    "top_municipalities": analytics.top_municipalities,
    "top_region": analytics.top_region,
    "top_disease": analytics.top_disease,
    "top_year": analytics.top_year,
    "top_municipality": analytics.top_municipality,
    "yearly_variation": analytics.yearly_variation,
    "trend_top5": analytics.trend_top,
    "geo_pivot": analytics.geo_pivot,
    "fastest_growing": analytics.fastest_growing,
    "compare_categories": analytics.compare_categories,
    "facet_values": analytics.facet_values,
    "forecast_4w": forecast.forecast_weeks,
    "summary_long": summary.summary_long,
    "insights": summary.insights,
}.items():
    _report(_name, _function)


@query
def summary_filtered(spark, sf_dir):
    """The summary of a selection."""
    return summary.summary_long(filters.apply_filters(tables.serving_keyed(spark, sf_dir), SELECTION))


@query
def geo_share_of_max(spark, sf_dir):
    return cleaning.round_metrics(analytics.geo_share_of_max(tables.serving(spark, sf_dir)), {"share": 6})


@query
def forecast_4w_by_disease(spark, sf_dir):
    return forecast.forecast_weeks(tables.serving(spark, sf_dir), by=["enfermedad"])


@query
def page_rows(spark, sf_dir):
    return paging.page_rows(tables.serving(spark, sf_dir), schemas.MASTER_KEYS, offset=100, limit=200)


@query
def page_rows_deep(spark, sf_dir):
    """The same page order, far into the table, by the stored index."""
    return tables.serving_index(spark, sf_dir).page(offset=1500, limit=50)


@query
def page_rows_seek(spark, sf_dir):
    """The same page without an index, found by seeking through counts."""
    return paging.page_rows(tables.serving(spark, sf_dir), schemas.MASTER_KEYS, offset=1500, limit=50, shallow=1000)


@query
def page_rows_unique_key(spark, sf_dir):
    """A deep page of an order whose first key is different in nearly every row, from an index of many ranges."""
    def lines() -> DataFrame:
        return star.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")

    return tables.page_index(spark, sf_dir, "line-pages", lines, ["l_orderkey", "l_linenumber"], 2_000).page(offset=5000, limit=100)


LATER = "ano >= 1996 and brote = 'NO'"


@query
def page_rows_filtered_deep(spark, sf_dir):
    """A page of the rows that fulfil a condition, by the stored index."""
    return tables.serving_index(spark, sf_dir).page(offset=700, limit=40, where=LATER)


@query
def page_json(spark, sf_dir):
    """Pages as nested records: a plain one, one of a condition, and one behind the end."""
    index = tables.serving_index(spark, sf_dir)
    pages = {"plain": records.page_record(index, 40, 25), "later": records.page_record(index, 300, 10, LATER), "behind": records.page_record(index, 10**9, 5)}
    return reduce(DataFrame.unionByName, [p.withColumn("page", F.lit(name)) for name, p in pages.items()])


@query
def summary_json(spark, sf_dir):
    """The summary of the whole table and of a selection as nested records."""
    whole, keyed = records.summary_record(tables.serving(spark, sf_dir)), tables.serving_keyed(spark, sf_dir)
    chosen = records.summary_record(filters.apply_filters(keyed, SELECTION))
    none = records.summary_record(keyed.where("ano < 0"))
    return reduce(DataFrame.unionByName, [d.withColumn("rows", F.lit(n)) for d, n in ((whole, "all"), (chosen, "selection"), (none, "none"))])


@query
def filtered_page(spark, sf_dir):
    """A page of a selection, with the number of rows of the whole selection."""
    page, total = paging.filtered_page(tables.serving_keyed(spark, sf_dir), SELECTION, schemas.MASTER_KEYS, offset=5, limit=20)
    return page.select(*schemas.MASTER.fieldNames()).withColumn("filtered_total", total.scalar())


# ---- conversations -----------------------------------------------------------------------


@query
def last_user_turn(spark, sf_dir):
    return conversations.last_user_turn(star.view(spark, sf_dir, star.QUESTIONS))


@query
def context_window(spark, sf_dir):
    """Sixteen latest turns of each conversation, one row per turn kept."""
    context = conversations.context_window(star.view(spark, sf_dir, star.QUESTIONS))
    return context.select("conv_id", F.posexplode("context").alias("position", "t")).select(
        "conv_id", "position", "t.turn", "t.role", "t.text"
    )


@query
def tag_intents(spark, sf_dir):
    return conversations.tag_intents(star.view(spark, sf_dir, star.QUESTIONS))
