import random

import pytest
from pyspark.sql import functions as F

from epiweave.functions import text as tx
from epiweave.operators import cleaning
from epiweave.operators.names import resolve_names


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in rows.select("i", expr("v").alias("out")).orderBy("i").collect()]


def test_place_text(spark):
    cases = {
        "Bogotá, D.C.": "BOGOTA",
        "BOGOTÁ D C": "BOGOTA",
        "* CALI. MUNICIPIO DESCONOCIDO": "CALI",
        "SANTA MARTHA": "SANTA MARTA",
        "  Cartagena de Indias ": "CARTAGENA",
        "BOGOTA DE CUNDINAMARCA": "BOGOTA DE CUNDINAMARCA",
        "nariño   alto": "NARINO ALTO",
        "N┴T═ËN": "NATION",
        "Curuman═": "CURUMANI",
        "MANGLED ß": "MANGLED A",
        None: None,
    }
    assert column(spark, list(cases), tx.normalize_text) == list(cases.values())


def test_place_text_keeps_small_accents_on_request(spark):
    got = column(spark, ["Bogotá, D.C.", "BOGOTÁ, D.C."], lambda c: tx.normalize_text(c, fold_small_accents=False))
    assert got == ["BOGOTÁ, D.C.", "BOGOTA"]


def test_harmonize(spark):
    got = column(spark, ["VALLE", "BOGOTA", "CAUCA", None], tx.harmonize)
    assert got == ["VALLE DEL CAUCA", "BOGOTA D.C.", "CAUCA", None]


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], "` Año` int, `Nombre Evento.` int")
    assert cleaning.normalize_headers(df).columns == ["ano", "nombre_evento"]
    assert tx.header_name(" Año ") == "ano"
    assert tx.landing_header_name(" a b:c-d ") == "a_b_c_d"
    assert tx.table_name("Casos (2020)-x.CSV") == "casos__2020__x"
    with pytest.raises(ValueError, match="collide"):
        cleaning.normalize_headers(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


def test_match_key_is_compatibility_decomposition(spark):
    draw = random.Random(7)
    pools = [(0x20, 0x17F), (0x300, 0x36F), (0x1E00, 0x1EFF), (0x2100, 0x218F), (0xFB00, 0xFB06), (0xFF00, 0xFF5E), (0x1D400, 0x1D4FF)]
    texts = ["".join(chr(draw.randint(*draw.choice(pools))) for _ in range(12)) for _ in range(3000)]
    texts += ["San Andrés, Providencia", "ﬁn ½ Ⅷ ™", "Straße", "", "é"]
    assert column(spark, texts, tx.match_key) == [tx.match_key_py(t) for t in texts]


def test_casts(spark):
    df = spark.createDataFrame([("3.0", "x"), ("3.9", "1.5"), ("abc", "NaN"), (None, None)], "a string, b string")
    got = cleaning.project_cast(df, {"n": ("a", "int"), "d": ("b", "double")}).collect()
    assert [tuple(r) for r in got] == [(3, None), (3, 1.5), (None, None), (None, None)]


def test_join_key_skips_nulls_and_categories(spark):
    df = spark.createDataFrame([(2020, 1, None, "CALI")], "ano int, semana int, d string, m string")
    assert cleaning.add_join_key(df, ["ano", "semana", "d", "m"]).first().join_key == "2020_1_CALI"
    kinds = spark.createDataFrame([("PM10",), ("TAire",), ("RUIDO",)], "v string").select(
        cleaning.category_by_membership("v", {"aire": ["PM10"], "temp": ["TAire"]}).alias("k")
    )
    assert [r.k for r in kinds.collect()] == ["aire", "temp", None]


def test_resolve_names(spark):
    regions = ["BOGOTA D.C.", "NORTE DE SANTANDER", "SANTANDER", "SAN ANDRES, PROVIDENCIA Y SANTA CATALINA", "META"]
    known = spark.createDataFrame([(r,) for r in regions], "departamento string")
    wanted = {
        "Bogotá D.C.": ("BOGOTA D.C.", "exact"),
        "Distrito Capital de Bogotá": ("BOGOTA D.C.", "exact"),
        "San Andrés y Providencia": ("SAN ANDRES, PROVIDENCIA Y SANTA CATALINA", "exact"),
        "Depto de Norte de Santander": ("NORTE DE SANTANDER", "contained"),
        "SANTANDER": ("SANTANDER", "exact"),
        "San Andrés": ("SAN ANDRES, PROVIDENCIA Y SANTA CATALINA", "contained"),
        "METAL": (None, None),
        "Tolima": (None, None),
    }
    names = spark.createDataFrame([(n,) for n in wanted] * 2, "nombre string")
    got = {r.nombre: (r.departamento, r.how) for r in resolve_names(names, known).collect()}
    assert got == wanted
    assert resolve_names(names.where(F.lit(False)), known).count() == 0
    long = spark.createDataFrame([("x" * 100_000 + " santander",)], "nombre string")
    assert [(r.departamento, r.how) for r in resolve_names(long, known).collect()] == [("SANTANDER", "contained")]
