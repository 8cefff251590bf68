"""Raw surveillance sources derived from a star schema of orders.

The statements are plain SQL that any engine can run, with table names as ``{placeholders}``.
Every row of the star schema's facts takes part. Orders stand for case reports: a customer's
nation and market segment make the municipality, the part type the disease and the quantity
the number of cases. Spellings vary by row the way landed files vary, so the cleaning rules
have work to do; some places lack climate or air stations, so imputation has too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

SEGMENT = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
    WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END"""

REGION_SHORT = """CASE n_regionkey WHEN 0 THEN 'Valle' WHEN 1 THEN 'Norte Santander'
    WHEN 2 THEN 'Bogotá, D.C.' WHEN 3 THEN 'GUAJIRA' ELSE 'San Andrés' END"""

REGION_LONG = """CASE n_regionkey WHEN 0 THEN 'VALLE DEL CAUCA' WHEN 1 THEN 'NORTE DE SANTANDER'
    WHEN 2 THEN 'BOGOTA' WHEN 3 THEN 'La Guajira'
    ELSE 'SAN ANDRES, PROVIDENCIA Y SANTA CATALINA' END"""

TOWN = """CASE n_nationkey WHEN 2 THEN 'Bogotá D.C.' WHEN 6 THEN 'Santa Martha'
    WHEN 7 THEN 'Cartagena de Indias' ELSE n_name END"""

# Sixty-fourths and eighths of a degree are exact in binary, so means of equal positions are
# exact as well and do not depend on the order of summation.
LATITUDE = f"CAST(-4 + (n_nationkey * 37 % 136) / 8e0 + ({SEGMENT}) * 11 / 64e0 AS DOUBLE)"
LONGITUDE = f"CAST(-81 + (n_nationkey * 53 % 104) / 8e0 + ({SEGMENT}) * 7 / 64e0 AS DOUBLE)"

# One line per order line, with its place.
PLACES = "JOIN {nation} ON c_nationkey = n_nationkey"
LINES = f"""
    {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
    JOIN {{customer}} ON o_custkey = c_custkey
    {PLACES}
"""

# The part of a line, which surveillance needs besides.
PARTS = "JOIN {part} ON l_partkey = p_partkey"

SURVEILLANCE = f"""
SELECT CAST(year(o_orderdate) AS STRING) AS ano,
    CAST(CAST(ceil(dayofyear(o_orderdate) / 7e0) AS INT) AS STRING) AS semana,
    {REGION_SHORT} AS departamento_ocurrencia,
    CASE o_orderkey % 5
        WHEN 0 THEN {TOWN} || ' ' || c_mktsegment
        WHEN 1 THEN '* ' || {TOWN} || ' ' || c_mktsegment
        WHEN 2 THEN {TOWN} || ' ' || c_mktsegment || '. MUNICIPIO DESCONOCIDO'
        WHEN 3 THEN replace(lower({TOWN} || ' ' || c_mktsegment), ' ', '   ')
        ELSE '  ' || {TOWN} || ' ' || c_mktsegment || ' ' END AS municipio_ocurrencia,
    CASE p_type WHEN 'ECONOMY' THEN ' Dengue' WHEN 'PROMO' THEN 'ZIKA '
        WHEN 'STANDARD' THEN 'Chikungunya' ELSE p_type END AS nombre_evento,
    CASE WHEN l_linenumber = 4 AND l_orderkey % 50 = 0 THEN 'ND'
        WHEN l_linenumber = 5 THEN CAST(CAST(l_quantity AS INT) AS STRING) || '.0'
        ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS conteo
FROM {LINES} {PARTS}
"""

CLIMATE_MONTH = "month(l_shipdate)"
CLIMATE_VALUE = """CASE l_returnflag WHEN 'A' THEN l_quantity
    WHEN 'N' THEN CAST(floor(l_extendedprice / 100e0) AS DOUBLE)
    ELSE CAST(floor(l_discount * 100e0) AS DOUBLE) END"""

# Places whose stations measure what the master table needs; the stations of other places
# measure other parameters only.
_HAS_CLIMATE = "(n_nationkey % 3 <> 0 AND c_mktsegment IN ('AUTOMOBILE', 'BUILDING'))"
_HAS_AIR = "(n_nationkey % 4 <> 0 AND c_mktsegment IN ('FURNITURE', 'HOUSEHOLD'))"

CLIMATE = f"""
SELECT translate(upper({REGION_LONG}), 'AIO', '┴═Ë') AS departamento,
    translate(upper({TOWN} || ' ' || c_mktsegment), 'AIO', '┴═Ë') AS municipio,
    CASE WHEN l_returnflag = 'R' OR NOT {_HAS_CLIMATE} THEN 'HUMEDAD RELATIVA'
        WHEN l_returnflag = 'A' THEN 'Temperatura media mensual' ELSE 'PRECIPITACIÓN' END AS par_metro,
    CASE l_linestatus WHEN 'O' THEN '1991-2020' ELSE '1981-2010' END AS ao,
    {LATITUDE} AS latitud, {LONGITUDE} AS longitud,
    {", ".join(f"max(CASE WHEN mes = {i + 1} THEN valor END) AS {m}"
               for i, m in enumerate("ene feb mar abr may jun jul ago sep oct nov dic".split()))}
FROM (SELECT n_nationkey, n_name, n_regionkey, c_mktsegment, l_returnflag, l_linestatus,
        {CLIMATE_MONTH} AS mes, avg({CLIMATE_VALUE}) AS valor
    FROM {LINES}
    GROUP BY n_nationkey, n_name, n_regionkey, c_mktsegment, l_returnflag, l_linestatus, {CLIMATE_MONTH}) m
GROUP BY n_nationkey, n_name, n_regionkey, c_mktsegment, l_returnflag, l_linestatus
"""

AIR = f"""
SELECT CAST(year(o_orderdate) AS STRING) AS a_o,
    {REGION_SHORT} AS nombre_del_departamento,
    upper({TOWN} || ' ' || c_mktsegment) AS nombre_del_municipio,
    CASE WHEN l_linenumber = 5 OR NOT {_HAS_AIR} THEN 'RUIDO' WHEN l_linenumber = 1 THEN 'PM10'
        WHEN l_linenumber = 2 THEN 'PM2.5' WHEN l_linenumber = 3 THEN 'TAire10'
        WHEN l_linenumber = 4 THEN 'O3' WHEN l_linenumber = 6 THEN 'TAire2' ELSE 'PST' END AS variable,
    avg(CAST(floor(l_tax * 1000e0) + l_linenumber AS DOUBLE)) AS promedio,
    {LATITUDE} AS latitud, {LONGITUDE} AS longitud
FROM {LINES}
GROUP BY year(o_orderdate), n_nationkey, n_name, n_regionkey, c_mktsegment, l_linenumber
"""

PROVIDERS = f"""
SELECT {REGION_LONG} AS departamentoprestadordesc,
    {TOWN} || ' ' || CASE s_suppkey % 5 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING'
        WHEN 2 THEN 'FURNITURE' WHEN 3 THEN 'HOUSEHOLD' ELSE 'MACHINERY' END AS municipioprestadordesc,
    CASE WHEN s_acctbal >= 0 THEN s_name END AS nombreprestador
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
"""

# One reading per order line, with missing and implausible values.
READINGS = """
SELECT l_orderkey, l_linenumber, l_suppkey,
    CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity END AS temperatura_promedio,
    l_quantity / 2 AS temperatura_promedio_aire,
    CAST(floor(l_extendedprice / 64e0) - 32 AS DOUBLE) AS precipitacion_promedio,
    CASE WHEN l_returnflag = 'N' AND l_linenumber = 2 THEN NULL
        ELSE CAST(floor(l_tax * 10000e0) - 50 AS DOUBLE) END AS calidad_aire_promedio,
    CAST(-6 + (l_suppkey * 7919 % 22000) / 1024e0 AS DOUBLE) AS latitud,
    CAST(-83 + (l_suppkey * 4729 % 19000) / 1024e0 AS DOUBLE) AS longitud,
    CAST(CAST(l_quantity AS INT) - 2 AS BIGINT) AS casos_totales
FROM {lineitem}
"""

# Customers and suppliers as points in the country's bounding box.
TARGET_POINTS = """
SELECT n_name AS departamento, c_name AS municipio,
    CAST(-5 + (c_custkey * 7919 % 20000) / 1000e0 AS DOUBLE) AS latitud,
    CAST(-82 + (c_custkey * 104729 % 17000) / 1000e0 AS DOUBLE) AS longitud
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""
REFERENCE_POINTS = """
SELECT n_name AS departamento, s_name AS municipio,
    CAST(-5 + (s_suppkey * 7919 % 20000) / 1000e0 AS DOUBLE) AS latitud,
    CAST(-82 + (s_suppkey * 104729 % 17000) / 1000e0 AS DOUBLE) AS longitud
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
"""

# Region names as free text, one row per customer.
FREE_NAMES = f"""
SELECT CASE c_custkey % 7 WHEN 0 THEN {REGION_SHORT} WHEN 1 THEN {REGION_LONG}
    WHEN 2 THEN 'Departamento de ' || {REGION_LONG}
    WHEN 3 THEN 'Archipiélago de San Andrés, Providencia y Santa Catalina'
    WHEN 4 THEN 'North Santander' WHEN 5 THEN n_name
    ELSE 'Distrito Capital de Bogotá' END AS nombre
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
"""

# Conversations whose user turns open with a question; the whole original text follows.
QUESTIONS = """
SELECT conv_id, turn, role,
    CASE WHEN role <> 'user' THEN text
        WHEN (conv_id + turn) % 23 = 11 THEN ''
        ELSE CASE (conv_id * 5 + turn) % 19
            WHEN 0 THEN 'Busco la enfermedad cuyo número crece con mayor rapidez. '
            WHEN 1 THEN 'Muéstrame el departamento que está más afectado hoy. '
            WHEN 2 THEN 'Una enfermedad muy común por aquí, ¿cuál sería? '
            WHEN 3 THEN 'Señala el año que reportó más casos. '
            WHEN 4 THEN 'Quiero leer el resumen corto '
            WHEN 5 THEN 'Síntomas del dengue '
            WHEN 6 THEN '¿Cómo evitar el zika? '
            WHEN 7 THEN '¿Cuándo consultar al médico por chik? '
            WHEN 8 THEN '¿Qué es el chikungunya? '
            WHEN 9 THEN '¿Cómo se transmite el dengue? '
            WHEN 10 THEN 'Compara dengue y zika '
            WHEN 11 THEN 'ayuda '
            WHEN 12 THEN '¿Cuántos casos hay en total? '
            WHEN 13 THEN '¿Cuántos registros hay? '
            WHEN 14 THEN 'Pronóstico para las próximas semanas '
            WHEN 15 THEN 'Háblame del Zika '
            ELSE '' END || text END AS text
FROM {conversations}
"""

# Landed headers, as they come with the files.
SURVEILLANCE_HEADERS = [
    " Año", "SEMANA", "Departamento Ocurrencia", "Municipio ocurrencia", "Nombre evento ", "Conteo.",
]
AIR_HEADERS = ["A_o", "Nombre del Departamento", "Nombre del Municipio", "Variable", "Promedio", "Latitud", "Longitud"]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Order lines that one task sorts, about.
TASK_LINES = 1 << 20


def _lines(spark: SparkSession, sf_dir: str, parts: bool) -> DataFrame:
    """Order lines with their order, its customer and, if asked for, their part.

    Lines meet their part first, while they are narrow, and then orders that have met their customers, of which there are fewer. So
    lines are shuffled once, or twice with parts, and no wide row is. What the climate takes of a line is worked out before.
    Many lines are sorted by as many more tasks.
    """
    lines, tasks = load(spark, sf_dir, "lineitem"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-lines.count() // TASK_LINES)
    lines = lines.selectExpr("*", f"{CLIMATE_VALUE} as valor_linea", f"{CLIMATE_MONTH} as mes_linea")
    if parts:
        lines = lines.join(load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if wanted > tasks:
        lines = lines.repartition(wanted, "l_orderkey")
    orders = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def view(spark: SparkSession, sf_dir: str, statement: str) -> DataFrame:
    """Run a statement of this module over the tables of a folder. Lines are joined in an order of their own, which gives the same
    rows; places are joined last, so that their names are not shuffled."""
    frames = {}
    if LINES in statement:
        frames["lines"] = _lines(spark, sf_dir, PARTS in statement)
        statement = statement.replace(LINES, f" {{lines}} {PLACES} ").replace(PARTS, "")
        statement = statement.replace(CLIMATE_VALUE, "valor_linea").replace(CLIMATE_MONTH, "mes_linea")
    frames |= {t: load(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in statement}
    return spark.sql(statement, **frames)


def raw_surveillance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, SURVEILLANCE).toDF(*SURVEILLANCE_HEADERS)


def raw_climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, CLIMATE)


def raw_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, AIR).toDF(*AIR_HEADERS)


def raw_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, PROVIDERS)
