import pytest
from pyspark.sql import functions as F

from epiweave import schemas
from epiweave.plans import conformed, master

MONTHS = {m: 20.0 + i for i, m in enumerate(schemas.MONTHS)}


@pytest.fixture
def raw(spark):
    surveillance = spark.createDataFrame(
        [
            ("2020", "1", "Bogotá, D.C.", "Bogotá, D.C.", "Dengue", "5"),
            ("2020", "1", "BOGOTA", "* BOGOTA", "DENGUE ", "7.0"),
            ("2020", "53", "BOGOTA", "BOGOTA", "ZIKA", "1"),
            ("2020", "2", "Valle", "Cali", "DENGUE", "ND"),
            ("2020", "2", "Valle", "Lejos", "DENGUE", "3"),
            ("2020", "2", "Valle", "Cali", "MALARIA", "9"),
        ], schemas.SURVEILLANCE_RAW,
    )
    climate = spark.createDataFrame(
        [("BOGOTA", "BOGOT┴", p, a, 4.6, -74.1, *[v * k for v in MONTHS.values()])
         for p, k in (("TEMPERATURA MEDIA", 1.0), ("PRECIPITACIÓN", 10.0)) for a in ("x", "y")]
        + [("VALLE DEL CAUCA", "YUMBO", "TEMPERATURA MEDIA", "x", 3.58, -76.49, *MONTHS.values()),
           ("VALLE DEL CAUCA", "YUMBO", "PRECIPITACION", "x", 3.58, -76.49, *MONTHS.values()),
           ("META", "META", "HUMEDAD", "x", 4.0, -73.0, *MONTHS.values())],
        schemas.CLIMATE_RAW,
    )
    air = spark.createDataFrame(
        [("2020", "BOGOTA", "BOGOTA", "PM10", 40.0, 4.6, -74.1), ("2020", "BOGOTA", "BOGOTA", "TAire", 14.0, 4.6, -74.1),
         ("2020", "VALLE", "CALI", "PM10", 30.0, 3.45, -76.53), ("2020", "VALLE", "CALI", "RUIDO", 900.0, 0.0, 0.0)],
        schemas.AIR_RAW,
    )
    providers = spark.createDataFrame(
        [("Bogotá D.C", "BOGOTA", "H1"), ("BOGOTA", "Bogotá", None), ("BOGOTA", "BOGOTA", "H2")], schemas.PROVIDERS_RAW
    )
    return surveillance, climate, air, providers


def test_surveillance_spellings_are_summed(raw):
    got = {(r.departamento, r.municipio, r.enfermedad, r.semana): r.casos_totales for r in conformed.surveillance_weekly(raw[0]).collect()}
    assert got[("BOGOTA D.C.", "BOGOTA", "DENGUE", 1)] == 12
    assert got[("VALLE DEL CAUCA", "CALI", "DENGUE", 2)] is None
    assert all(k[2] != "MALARIA" for k in got)


def test_climate_weeks(raw):
    got = conformed.climate_weekly(raw[1]).where("municipio = 'BOGOTA'").orderBy("semana").collect()
    assert [r.semana for r in got] == list(range(1, 53))
    assert got[0].temperatura_promedio == 20.0 and got[51].temperatura_promedio == 31.0
    assert got[4].precipitacion_promedio == 210.0 and got[0].latitud == pytest.approx(4.6)
    assert conformed.climate_weekly(raw[1]).where("municipio = 'META'").count() == 0


def test_master(raw):
    got = {(r.municipio, r.semana): r for r in master.master_dataset(*raw).collect()}
    assert set(got) == {("BOGOTA", 1), ("CALI", 2)}
    bogota, cali = got["BOGOTA", 1], got["CALI", 2]
    assert (bogota.casos_totales, bogota.cantidad_hospitales, bogota.vacunacion) == (12, 2, "NO_REPORTA")
    assert (bogota.temperatura_promedio, bogota.calidad_aire_promedio) == (20.0, 40.0)
    # Cali has no climate station; the one in Yumbo is within the radius.
    assert (cali.casos_totales, cali.temperatura_promedio, cali.latitud, cali.brote) == (0, 20.0, 3.45, "NO")


def test_master_keys_are_unique(raw):
    """Repeated raw rows of every source add no row to the master table, complete or not."""
    doubled = [rows.unionByName(rows) for rows in raw]
    joined = master.master_joined(master.conform(*doubled))
    assert joined.count() == joined.select(*schemas.MASTER_KEYS).distinct().count() > 0
    table = master.master_dataset(*doubled)
    assert table.count() == table.distinct().count() == 2


def test_master_columns_and_unfiltered_rows(raw):
    joined = master.master_joined(master.conform(*raw))
    assert joined.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.MASTER.fields]
    rows = {(r.municipio, r.semana): r for r in joined.collect()}
    assert len(rows) == 4
    assert rows["LEJOS", 2].temperatura_promedio is None and rows["LEJOS", 2].latitud is None
    # Week 53 has neither climate nor air, but keeps its place.
    late = rows["BOGOTA", 53]
    assert late.temperatura_promedio is None and late.calidad_aire_promedio is None and late.latitud == 4.6
    kept = master.clean_master(joined, required=["casos_totales", "latitud", "longitud"])
    assert kept.count() == 2


def test_outbreak_share(spark):
    from epiweave.operators.label import outbreak_label

    base = spark.range(4000).select(
        (F.col("id") % 7).cast("string").alias("enfermedad"), (F.col("id") % 3).cast("string").alias("municipio"),
        (F.hash("id") % 50).cast("bigint").alias("casos_totales"),
    )
    shares = outbreak_label(base).groupBy("enfermedad", "municipio").agg(F.avg((F.col("brote") == "SI").cast("int")).alias("s"))
    assert all(r.s <= 0.25 for r in shares.collect())
