"""One SQL statement per registered query, written apart from the Spark jobs.

Statements run in DuckDB over the same tables. They share only the raw-source views with the
Spark side; every operator is stated again in plain SQL, as directly as possible: neighbours by
comparing all pairs, weeks by joining a calendar, means of means in the order of the rules.
"""

from __future__ import annotations

import re

from epiweave.sources import star

ORACLES: dict[str, str] = {}

TABLE_NAMES = {t: t for t in star.TABLES}


def raw(statement: str) -> str:
    return statement.format(**TABLE_NAMES)


def half_up(x: str, n: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(30, 12)), {n}) AS DOUBLE)"


def half_even(x: str, n: int) -> str:
    return f"CAST(round_even(CAST({x} AS DECIMAL(30, 12)), {n}) AS DOUBLE)"


def norm(x: str) -> str:
    """Place text in canonical form."""
    out = f"upper(trim(translate({x}, '┴═ËÐÝ¾ß×¡¢£¤', 'AIONIOAOAEIO')))"
    out = f"translate({out}, 'ÁÉÍÓÚÑÜ', 'AEIOUNU')"
    for pattern, new in [
        (r"^\*\s*", ""), (r"\.\s*MUNICIPIO\s*DESCONOCIDO", ""), (r"BOGOTA\s*,?\s*D\.?\s*C\.?", "BOGOTA"),
        ("SANTA MARTHA", "SANTA MARTA"), ("CARTAGENA DE INDIAS", "CARTAGENA"), (r"\s+", " "),
    ]:
        out = f"regexp_replace({out}, '{pattern}', '{new}', 'g')"
    return f"trim({out})"


def official(x: str) -> str:
    return (
        f"CASE {x} WHEN 'VALLE' THEN 'VALLE DEL CAUCA' WHEN 'NORTE SANTANDER' THEN 'NORTE DE SANTANDER' "
        f"WHEN 'BOGOTA' THEN 'BOGOTA D.C.' WHEN 'GUAJIRA' THEN 'LA GUAJIRA' "
        f"WHEN 'SAN ANDRES' THEN 'SAN ANDRES, PROVIDENCIA Y SANTA CATALINA' ELSE {x} END"
    )


def dept(x: str) -> str:
    return official(norm(x))


def key(x: str) -> str:
    return f"trim(regexp_replace(upper(strip_accents(replace({x}, 'ß', 'SS'))), '[^A-Z0-9]+', ' ', 'g'))"


def whole(x: str) -> str:
    return f"CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS INTEGER)"


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371 * asin(least(1.0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


MONTHS = "ene feb mar abr may jun jul ago sep oct nov dic".split()
_MONTH_VALUE = "CASE i " + " ".join(f"WHEN {i} THEN {m}" for i, m in enumerate(MONTHS, 1)) + " END"
_MONTH_NAME = "CASE i " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MONTHS, 1)) + " END"
PARAMETER = """CASE WHEN contains({0}, 'TEMPERATURA MEDIA') THEN 'temperatura_promedio'
    WHEN contains({0}, 'PRECIPITACION') THEN 'precipitacion_promedio' END"""
POLLUTANTS = "('PM2.5', 'PM10', 'O3', 'NO2', 'SO2', 'CO', 'PST')"
AIR_TEMPERATURES = "('TAire', 'TAire10', 'TAire2')"


def neighbor(refs: str, lat: str, lon: str) -> str:
    distance = km("t.latitud", "t.longitud", f"r.{lat}", f"r.{lon}")
    return f"""
SELECT target_dept, target_muni, ref_dept, ref_muni, dist_km FROM (
    SELECT *, row_number() OVER (PARTITION BY target_dept, target_muni ORDER BY dist_km, ref_dept, ref_muni) AS rn
    FROM (SELECT t.departamento AS target_dept, t.municipio AS target_muni,
            r.departamento AS ref_dept, r.municipio AS ref_muni, {distance} AS dist_km
        FROM (SELECT DISTINCT departamento, municipio, latitud, longitud FROM vsp JOIN geo USING (departamento, municipio)) t,
            (SELECT DISTINCT departamento, municipio, {lat}, {lon} FROM {refs}) r)
    WHERE dist_km <= 50)
WHERE rn = 1"""


COUNTED = "ano, semana, departamento, municipio, enfermedad, coalesce(casos_totales, 0) AS casos_totales"
MASTER_COLUMNS = """ano, semana, departamento, municipio, enfermedad, casos_totales, temperatura_promedio,
    precipitacion_promedio, calidad_aire_promedio, vacunacion, cantidad_hospitales, latitud, longitud, brote"""

# Named intermediate results, each with the ones it reads.
PARTS: dict[str, tuple[list[str], str]] = {
    "raw_vig": ([], raw(star.SURVEILLANCE)),
    "raw_cli": ([], raw(star.CLIMATE)),
    "raw_air": ([], raw(star.AIR)),
    "raw_prov": ([], raw(star.PROVIDERS)),
    "lecturas": ([], raw(star.READINGS)),
    "preguntas": ([], raw(star.QUESTIONS)),
    "meses": ([], "SELECT i, w AS semana FROM range(1, 13) a(i), range(1, 53) b(w) WHERE i = least((w - 1) // 4, 11) + 1"),
    "vsp": (["raw_vig"], f"""
SELECT {whole('ano')} AS ano, {whole('semana')} AS semana, {dept('departamento_ocurrencia')} AS departamento,
    {norm('municipio_ocurrencia')} AS municipio, {norm('nombre_evento')} AS enfermedad,
    CAST(sum({whole('conteo')}) AS BIGINT) AS casos_totales
FROM raw_vig WHERE {norm('nombre_evento')} IN ('DENGUE', 'ZIKA', 'CHIKUNGUNYA') GROUP BY 1, 2, 3, 4, 5"""),
    "clima_largo": (["raw_cli", "meses"], f"""
SELECT semana, {dept('departamento')} AS departamento, {norm('municipio')} AS municipio,
    {PARAMETER.format(norm('par_metro'))} AS medida, latitud, longitud, {_MONTH_VALUE} AS valor
FROM raw_cli, meses"""),
    "clima_medio": (["clima_largo"], """
SELECT semana, departamento, municipio, medida, avg(valor) AS valor, avg(latitud) AS latitud, avg(longitud) AS longitud
FROM clima_largo WHERE medida IS NOT NULL GROUP BY 1, 2, 3, 4"""),
    "clima": (["clima_medio"], """
SELECT semana, departamento, municipio,
    avg(CASE WHEN medida = 'temperatura_promedio' THEN valor END) AS temperatura_promedio,
    avg(CASE WHEN medida = 'precipitacion_promedio' THEN valor END) AS precipitacion_promedio,
    avg(latitud) AS latitud, avg(longitud) AS longitud
FROM clima_medio GROUP BY 1, 2, 3"""),
    "aire": (["raw_air"], f"""
SELECT {whole('a_o')} AS ano, {dept('nombre_del_departamento')} AS departamento, {norm('nombre_del_municipio')} AS municipio,
    avg(promedio) FILTER (variable IN {POLLUTANTS}) AS calidad_aire_promedio,
    avg(promedio) FILTER (variable IN {AIR_TEMPERATURES}) AS temperatura_promedio_aire,
    avg(latitud) AS latitud_aire, avg(longitud) AS longitud_aire
FROM raw_air WHERE variable IN {POLLUTANTS} OR variable IN {AIR_TEMPERATURES} GROUP BY 1, 2, 3"""),
    "hosp": (["raw_prov"], f"""
SELECT {dept('departamentoprestadordesc')} AS departamento, {norm('municipioprestadordesc')} AS municipio,
    count(nombreprestador) AS cantidad_hospitales
FROM raw_prov GROUP BY 1, 2"""),
    "geo": (["clima", "aire"], """
SELECT departamento, municipio, avg(latitud) AS latitud, avg(longitud) AS longitud FROM (
    SELECT DISTINCT departamento, municipio, latitud, longitud FROM clima
    UNION ALL SELECT DISTINCT departamento, municipio, latitud_aire, longitud_aire FROM aire) GROUP BY 1, 2"""),
    "a_clima": (["vsp", "geo", "clima"], neighbor("clima", "latitud", "longitud")),
    "a_aire": (["vsp", "geo", "aire"], neighbor("aire", "latitud_aire", "longitud_aire")),
    "umbrales": (["vsp"], "SELECT enfermedad, municipio, quantile_disc(casos_totales, 0.75) AS umbral FROM vsp GROUP BY 1, 2"),
    "marcado": (["vsp", "umbrales"], """
SELECT ano, semana, departamento, municipio, enfermedad, coalesce(casos_totales, 0) AS casos_totales,
    CASE WHEN coalesce(casos_totales, 0) > coalesce(umbral, 0) THEN 'SI' ELSE 'NO' END AS brote
FROM vsp LEFT JOIN umbrales USING (enfermedad, municipio)"""),
    "unido": (["marcado", "a_clima", "a_aire", "clima", "aire", "hosp", "geo"], f"""
SELECT m.ano, m.semana, m.departamento, m.municipio, m.enfermedad, m.casos_totales,
    {half_up('coalesce(c.temperatura_promedio, a.temperatura_promedio_aire)', 2)} AS temperatura_promedio,
    {half_up('c.precipitacion_promedio', 2)} AS precipitacion_promedio,
    {half_up('a.calidad_aire_promedio', 2)} AS calidad_aire_promedio,
    'NO_REPORTA' AS vacunacion, coalesce(h.cantidad_hospitales, 0) AS cantidad_hospitales,
    {half_up('coalesce(g.latitud, c.latitud, a.latitud_aire)', 5)} AS latitud,
    {half_up('coalesce(g.longitud, c.longitud, a.longitud_aire)', 5)} AS longitud, m.brote
FROM marcado m
LEFT JOIN a_clima mc ON mc.target_dept = m.departamento AND mc.target_muni = m.municipio
LEFT JOIN clima c ON c.semana = m.semana AND c.departamento = coalesce(mc.ref_dept, m.departamento)
    AND c.municipio = coalesce(mc.ref_muni, m.municipio)
LEFT JOIN a_aire ma ON ma.target_dept = m.departamento AND ma.target_muni = m.municipio
LEFT JOIN aire a ON a.ano = m.ano AND m.semana BETWEEN 1 AND 52 AND a.departamento = coalesce(ma.ref_dept, m.departamento)
    AND a.municipio = coalesce(ma.ref_muni, m.municipio)
LEFT JOIN hosp h ON h.departamento = m.departamento AND h.municipio = m.municipio
LEFT JOIN geo g ON g.departamento = m.departamento AND g.municipio = m.municipio"""),
    "completo": (["unido"], """
SELECT * FROM unido WHERE temperatura_promedio IS NOT NULL AND precipitacion_promedio IS NOT NULL
    AND calidad_aire_promedio IS NOT NULL AND latitud IS NOT NULL AND longitud IS NOT NULL AND ano IS NOT NULL
    AND semana IS NOT NULL AND departamento IS NOT NULL AND municipio IS NOT NULL AND enfermedad IS NOT NULL"""),
    "maestro": (["completo"], """
SELECT DISTINCT * FROM completo WHERE temperatura_promedio BETWEEN 0 AND 45 AND precipitacion_promedio BETWEEN 0 AND 1200
    AND calidad_aire_promedio BETWEEN 0 AND 500 AND latitud BETWEEN -5 AND 15 AND longitud BETWEEN -82 AND -65
    AND casos_totales >= 0"""),
}


def sql(name: str, reads: list[str], statement: str) -> None:
    """Register a statement with the named parts it needs, in order of dependence."""
    needed: list[str] = []

    def add(part: str) -> None:
        for other in PARTS[part][0]:
            add(other)
        if part not in needed:
            needed.append(part)

    for part in reads:
        add(part)
    head = ",\n".join(f"{p} AS MATERIALIZED ({PARTS[p][1]})" for p in needed)
    # A statement that starts with a comma continues the list of named results.
    ORACLES[name] = (f"WITH {head}\n" if head else "") + statement.strip()


# ---- sources and sinks -------------------------------------------------------------------

sql("scan_csv_roundtrip", ["raw_vig"], "SELECT *, count(*) AS filas FROM raw_vig GROUP BY ALL")
sql("scan_encoding_fallback", [], "SELECT * FROM documents")
sql("scan_json_pages", [], "SELECT * FROM orders")
sql("json_pages_report", [], """
WITH paginas AS (SELECT CASE WHEN p = 3 AND o_orderkey % 2 = 0 THEN 1000 WHEN p = 5 THEN 1002 ELSE p END AS page, count(*) AS rows
    FROM (SELECT o_orderkey, o_orderkey // 2000 AS p FROM orders) GROUP BY 1)
SELECT CAST(page AS INTEGER) AS page, rows,
    CASE WHEN page = (SELECT max(page) FROM paginas) THEN 'last' WHEN rows < 2000 THEN 'short' ELSE 'ok' END AS status FROM paginas
UNION ALL
SELECT DISTINCT CAST(page + 1 AS INTEGER), 0, 'gap' FROM (SELECT page FROM paginas UNION ALL SELECT -1)
WHERE page + 1 NOT IN (SELECT page FROM paginas) AND page < (SELECT max(page) FROM paginas)""")
sql("ingest_folder_report", [], """
SELECT 'Segmento-' || coalesce(c_mktsegment, 'NINGUNO') || ' (2024).csv' AS file,
    'segmento_' || lower(coalesce(c_mktsegment, 'NINGUNO')) || '__2024_' AS table_name, 'ok' AS status, 5 AS columns, count(*) AS rows
FROM customer GROUP BY c_mktsegment""")
_SEGMENT_SUMS = """SELECT 'segmento_' || lower(coalesce(c_mktsegment, 'NINGUNO')) || '__2024_' AS table_name, '{}' AS reader, count(*) AS filas,
    CAST(sum(CAST(c_acctbal AS DECIMAL(15, 2))) AS DOUBLE) AS saldo FROM customer WHERE c_custkey % {} = 0 GROUP BY c_mktsegment"""
sql("ingest_folder_tables", [], _SEGMENT_SUMS.format("before", 2) + "\nUNION ALL " + _SEGMENT_SUMS.format("after", 1))
sql("replace_table", ["maestro"], f"SELECT {MASTER_COLUMNS} FROM (SELECT * REPLACE (2 * casos_totales AS casos_totales) FROM maestro WHERE brote = 'SI')")
_EXPORT = "SELECT '{}' AS selection, CASE WHEN {} > 300000 THEN 'refused' ELSE 'written' END AS status, {} AS rows, CAST(300000 AS BIGINT) AS max_rows FROM {}"
sql("export_report", ["vsp"], _EXPORT.format("cases", "count(*)", "count(*)", "vsp") + "\nUNION ALL "
    + _EXPORT.format("weekly readings", "52 * count(*)", "52 * count(*)", "lineitem"))
sql("table_meta", ["maestro"], """
SELECT CAST(position AS INTEGER) AS position, column_name, data_type, (SELECT count(*) FROM maestro) AS total_rows
FROM (VALUES (1, 'ano', 'int'), (2, 'semana', 'int'), (3, 'departamento', 'string'), (4, 'municipio', 'string'),
    (5, 'enfermedad', 'string'), (6, 'casos_totales', 'bigint'), (7, 'temperatura_promedio', 'double'),
    (8, 'precipitacion_promedio', 'double'), (9, 'calidad_aire_promedio', 'double'), (10, 'vacunacion', 'string'),
    (11, 'cantidad_hospitales', 'bigint'), (12, 'latitud', 'double'), (13, 'longitud', 'double'),
    (14, 'brote', 'string')) c(position, column_name, data_type)""")
for _name in ("sink_roundtrip_csv", "sink_roundtrip_parquet", "master_dataset", "master_from_landed_csv"):
    sql(_name, ["maestro"], f"SELECT {MASTER_COLUMNS} FROM maestro")
sql("guarded_export", ["maestro"], f"SELECT {MASTER_COLUMNS} FROM maestro WHERE enfermedad = 'DENGUE' AND ano >= 1998")

# ---- projection and cleaning -------------------------------------------------------------

sql("normalize_headers", ["raw_vig"], """
SELECT ano, nombre_evento, count(conteo) AS conteos, count(municipio_ocurrencia) AS municipios FROM raw_vig GROUP BY 1, 2""")
sql("normalize_headers_landing", [], """
SELECT c_custkey, c_name, c_nationkey, c_acctbal AS c_acct_bal, c_mktsegment AS segment FROM customer""")
sql("normalize_text", ["raw_vig"], f"""
SELECT {norm('departamento_ocurrencia')} AS departamento_ocurrencia, {norm('municipio_ocurrencia')} AS municipio_ocurrencia,
    {norm('nombre_evento')} AS nombre_evento, municipio_ocurrencia AS municipio_original, filas
FROM (SELECT departamento_ocurrencia, municipio_ocurrencia, nombre_evento, count(*) AS filas FROM raw_vig GROUP BY 1, 2, 3)""")
sql("normalize_text_mangled", ["raw_cli"], f"""
SELECT municipio AS original, {norm('departamento')} AS departamento, {norm('municipio')} AS municipio,
    {norm('par_metro')} AS par_metro, ao FROM raw_cli""")
sql("match_key", [], f"SELECT doc_id, {key('text')} AS clave FROM documents")
sql("harmonize_names", ["raw_vig"], f"""
SELECT departamento_ocurrencia AS original, count(*) AS filas, {dept('departamento_ocurrencia')} AS departamento
FROM raw_vig GROUP BY 1""")
sql("project_cast", ["raw_vig"], f"""
SELECT {whole('ano')} AS ano, {whole('semana')} AS semana, departamento_ocurrencia AS departamento, nombre_evento AS enfermedad,
    CAST(coalesce(sum({whole('conteo')}), 0) AS BIGINT) AS casos, count(*) - count({whole('conteo')}) AS sin_dato,
    count(DISTINCT municipio_ocurrencia) AS municipios
FROM raw_vig GROUP BY 1, 2, 3, 4""")
sql("categorize_case", ["raw_air", "raw_cli"], f"""
SELECT variable, grupo, count(*) AS filas FROM (
    SELECT variable, CASE WHEN variable IN {POLLUTANTS} THEN 'calidad_aire' WHEN variable IN {AIR_TEMPERATURES} THEN 'temperatura' END AS grupo
    FROM raw_air
    UNION ALL SELECT {norm('par_metro')}, {PARAMETER.format(norm('par_metro'))} FROM raw_cli) GROUP BY 1, 2""")
sql("enforce_schema", ["vsp"], """
SELECT ano, semana, departamento, municipio, enfermedad, coalesce(casos_totales, 0) AS casos_totales, CAST(NULL AS DOUBLE) AS temperatura_promedio,
    CAST(NULL AS DOUBLE) AS precipitacion_promedio, CAST(NULL AS DOUBLE) AS calidad_aire_promedio, 'NO_REPORTA' AS vacunacion,
    CAST(0 AS BIGINT) AS cantidad_hospitales, CAST(NULL AS DOUBLE) AS latitud, CAST(NULL AS DOUBLE) AS longitud,
    CAST(NULL AS VARCHAR) AS brote FROM vsp""")
sql("join_key", ["vsp"], """
SELECT ano || '_' || semana || '_' || departamento || '_' || municipio AS join_key, count(*) AS filas FROM vsp GROUP BY 1""")
sql("fill_nulls", ["lecturas"], """
SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(temperatura_promedio, 0) AS temperatura_promedio,
    coalesce(calidad_aire_promedio, -1) AS calidad_aire_promedio FROM lecturas""")
sql("coalesce_sources", ["lecturas"], """
SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(temperatura_promedio, temperatura_promedio_aire) AS temperatura_promedio
FROM lecturas""")
sql("round_metrics", ["lecturas"], f"""
SELECT l_orderkey, l_linenumber, l_suppkey, {half_up('latitud', 2)} AS latitud, {half_up('longitud', 1)} AS longitud FROM lecturas""")

# ---- filters and quality -----------------------------------------------------------------

_RANGES = {
    "temperatura_promedio": "temperatura_promedio BETWEEN 0 AND 45",
    "precipitacion_promedio": "precipitacion_promedio BETWEEN 0 AND 1200",
    "calidad_aire_promedio": "calidad_aire_promedio BETWEEN 0 AND 500",
    "latitud": "latitud BETWEEN -5 AND 15",
    "longitud": "longitud BETWEEN -82 AND -65",
    "casos_totales": "casos_totales >= 0",
}
_ALL_RANGES = " AND ".join(_RANGES.values())
_REJECTS = "\nUNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) AS rejected FROM lecturas WHERE ({test}) IS NOT TRUE"
    for name, test in [*_RANGES.items(), ("any_rule", _ALL_RANGES)]
)
sql("filter_categories", ["vsp"], f"SELECT {COUNTED} FROM vsp WHERE enfermedad IN ('DENGUE', 'ZIKA')")
sql("sanity_filters", ["lecturas"], f"SELECT * FROM lecturas WHERE {_ALL_RANGES}")
sql("sanity_rejects", ["lecturas"], _REJECTS)
sql("drop_incomplete", ["completo"], f"SELECT {MASTER_COLUMNS} FROM completo")
sql("dedupe_rows", ["raw_vig"], "SELECT DISTINCT * FROM raw_vig")
sql("null_audit", ["unido"], "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, "
    f"CAST(round(CAST((count(*) - count({c})) * 100.0 / count(*) AS DECIMAL(30, 12)), 1) AS DOUBLE) AS pct FROM unido"
    for c in MASTER_COLUMNS.replace("\n", " ").replace(" ", "").split(",")
))
_QUALITY_KEYS = ["ano", "semana", "departamento_ocurrencia", "municipio_ocurrencia", "nombre_evento", "conteo"]
sql("key_quality_report", ["raw_vig"], "\nUNION ALL ".join(
    ["SELECT 'rows' AS check_name, count(*) AS value FROM raw_vig"]
    + [f"SELECT 'nulls_{c}', count(*) FROM raw_vig WHERE {'TRY_CAST(conteo AS DOUBLE)' if c == 'conteo' else c} IS NULL" for c in _QUALITY_KEYS]
    + ["""SELECT 'duplicates', (SELECT count(*) FROM raw_vig) - (SELECT count(*) FROM
        (SELECT DISTINCT ano, semana, departamento_ocurrencia, municipio_ocurrencia, nombre_evento, TRY_CAST(conteo AS DOUBLE) AS c FROM raw_vig))"""]
))


def _found(needle: str, literal: bool) -> str:
    test = "contains(upper({0}), upper('{1}'))" if literal else "regexp_matches({0}, '{1}', 'i')"
    return "(" + " OR ".join(test.format(c, needle) for c in ("departamento", "municipio", "enfermedad")) + ")"


sql("search_text", ["maestro"], f"SELECT {MASTER_COLUMNS} FROM maestro WHERE {_found(r'nation_\d1?.* auto|cartagena', False)}")
sql("search_text_literal", ["maestro"], f"SELECT {MASTER_COLUMNS} FROM maestro WHERE {_found('d.c.', True)}")
sql("filter_set_normalized", ["maestro"], f"""
SELECT {MASTER_COLUMNS} FROM maestro
WHERE {key('departamento')} IN ('BOGOTA D C', 'LA GUAJIRA', 'SAN ANDRES PROVIDENCIA Y SANTA CATALINA')""")
sql("filter_eq_normalized", ["maestro"], f"SELECT {MASTER_COLUMNS} FROM maestro WHERE {key('municipio')} = 'NATION 5 BUILDING'")
sql("filter_year_range", ["maestro"], f"SELECT {MASTER_COLUMNS} FROM maestro WHERE ano BETWEEN 1996 AND 1998")
PARTS["seleccion"] = (["maestro"], f"""
SELECT {MASTER_COLUMNS} FROM maestro WHERE {_found('nation|santa', False)}
    AND departamento IN ('VALLE DEL CAUCA', 'NORTE DE SANTANDER') AND enfermedad IN ('DENGUE', 'ZIKA')
    AND brote = 'SI' AND ano BETWEEN 1996 AND 2000""")
sql("filter_combined", ["seleccion"], "SELECT * FROM seleccion")

# ---- joins and geography -----------------------------------------------------------------


PARTS["clientes"] = ([], raw(star.TARGET_POINTS))
PARTS["proveedores"] = ([], raw(star.REFERENCE_POINTS))


def _nearest(targets: str, refs: str, radius: int) -> str:
    distance = km("t.latitud", "t.longitud", "r.latitud", "r.longitud")
    return f"""
SELECT target_dept, target_muni, ref_dept, ref_muni, {half_up('dist_km', 6)} AS dist_km FROM (
    SELECT *, row_number() OVER (PARTITION BY target_dept, target_muni ORDER BY dist_km, ref_dept, ref_muni) AS rn
    FROM (SELECT t.departamento AS target_dept, t.municipio AS target_muni, r.departamento AS ref_dept,
            r.municipio AS ref_muni, {distance} AS dist_km
        FROM {targets} t, {refs} r)
    WHERE dist_km <= {radius})
WHERE rn = 1"""


sql("nearest_within_radius", ["clientes", "proveedores"], _nearest("clientes", "proveedores", 50))
sql("nearest_dense", ["clientes", "proveedores"], _nearest("proveedores", "clientes", 500))
sql("coordinate_reference", ["geo"], "SELECT * FROM geo")
sql("left_join_dims", ["vsp", "geo", "hosp"], f"""
SELECT {COUNTED}, latitud, longitud, coalesce(cantidad_hospitales, 0) AS cantidad_hospitales FROM vsp LEFT JOIN geo USING (departamento, municipio) LEFT JOIN hosp USING (departamento, municipio)""")
sql("neighbor_map", ["a_clima", "a_aire"], f"""
SELECT target_dept, target_muni, ref_dept, ref_muni, {half_up('dist_km', 6)} AS dist_km, fuente FROM
    (SELECT *, 'clima' AS fuente FROM a_clima UNION ALL SELECT *, 'aire' FROM a_aire)""")
sql("impute_from_neighbor_week", ["vsp", "a_clima", "clima"], f"""
SELECT v.* REPLACE (coalesce(casos_totales, 0) AS casos_totales), {half_up('c.temperatura_promedio', 6)} AS temperatura_promedio, {half_up('c.precipitacion_promedio', 6)} AS precipitacion_promedio
FROM vsp v LEFT JOIN a_clima m ON m.target_dept = v.departamento AND m.target_muni = v.municipio
LEFT JOIN clima c ON c.semana = v.semana AND c.departamento = coalesce(m.ref_dept, v.departamento)
    AND c.municipio = coalesce(m.ref_muni, v.municipio)""")
sql("impute_from_neighbor_year", ["vsp", "a_aire", "aire"], f"""
SELECT v.* REPLACE (coalesce(casos_totales, 0) AS casos_totales), {half_up('a.calidad_aire_promedio', 6)} AS calidad_aire_promedio, {half_up('a.temperatura_promedio_aire', 6)} AS temperatura_promedio_aire
FROM vsp v LEFT JOIN a_aire m ON m.target_dept = v.departamento AND m.target_muni = v.municipio
LEFT JOIN aire a ON a.ano = v.ano AND a.departamento = coalesce(m.ref_dept, v.departamento)
    AND a.municipio = coalesce(m.ref_muni, v.municipio)""")


def alias(x: str) -> str:
    return (
        f"CASE {x} WHEN 'BOGOTA DC' THEN 'BOGOTA' WHEN 'BOGOTA D C' THEN 'BOGOTA' WHEN 'DISTRITO CAPITAL DE BOGOTA' THEN 'BOGOTA' "
        f"WHEN 'NORTE DE SANTANDER' THEN 'NORTH SANTANDER' "
        f"WHEN 'SAN ANDRES PROVIDENCIA Y SANTA CATALINA' THEN 'SAN ANDRES Y PROVIDENCIA' "
        f"WHEN 'ARCHIPIELAGO DE SAN ANDRES PROVIDENCIA Y SANTA CATALINA' THEN 'SAN ANDRES Y PROVIDENCIA' ELSE {x} END"
    )


sql("resolve_region_names", ["vsp"], f"""
, libres AS (SELECT nombre, count(*) AS filas, {key('nombre')} AS llano FROM ({raw(star.FREE_NAMES)}) GROUP BY 1),
regiones AS (SELECT DISTINCT departamento, {key('departamento')} AS plano FROM vsp),
pares AS (
    SELECT nombre, departamento, {alias('llano')} = {alias('plano')} AS igual,
        CASE WHEN length(llano) > 4 AND contains(plano, llano) THEN length(llano)
            WHEN length(plano) > 4 AND contains(llano, plano) THEN length(plano) END AS comun
    FROM libres, regiones),
mejor AS (
    SELECT nombre, departamento, igual, row_number() OVER (PARTITION BY nombre ORDER BY igual DESC, CASE WHEN igual THEN 0 ELSE -comun END, departamento) AS rn
    FROM pares WHERE igual OR comun IS NOT NULL)
SELECT nombre, filas, departamento, CASE WHEN igual THEN 'exact' WHEN departamento IS NOT NULL THEN 'contained' END AS how
FROM libres LEFT JOIN (SELECT * FROM mejor WHERE rn = 1) USING (nombre)""")

# ---- aggregates and labels ---------------------------------------------------------------

sql("cases_by_key", ["raw_vig"], f"""
SELECT {whole('ano')} AS ano, {whole('semana')} AS semana, departamento_ocurrencia AS departamento,
    municipio_ocurrencia AS municipio, nombre_evento AS enfermedad, CAST(coalesce(sum({whole('conteo')}), 0) AS BIGINT) AS casos_totales
FROM raw_vig GROUP BY 1, 2, 3, 4, 5""")
sql("outbreak_threshold", ["umbrales"], "SELECT * FROM umbrales")
sql("outbreak_label", ["marcado"], "SELECT * FROM marcado")

# ---- reshape and source jobs -------------------------------------------------------------

sql("unpivot_months", ["raw_cli"], f"""
SELECT departamento, municipio, par_metro, ao, {_MONTH_NAME} AS month_name, {half_up(_MONTH_VALUE, 6)} AS valor
FROM raw_cli, range(1, 13) m(i)""")
sql("month_to_week", ["raw_cli", "meses"], f"""
SELECT departamento, municipio, par_metro, ao, CAST(semana AS INTEGER) AS semana, {half_up(_MONTH_VALUE, 6)} AS valor FROM raw_cli, meses""")
sql("pivot_parameters", ["raw_cli"], f"""
SELECT departamento, municipio, month_name, {half_up("avg(valor) FILTER (medida = 'temperatura_promedio')", 6)} AS temperatura_promedio,
    {half_up("avg(valor) FILTER (medida = 'precipitacion_promedio')", 6)} AS precipitacion_promedio
FROM (SELECT departamento, municipio, {_MONTH_NAME} AS month_name, {_MONTH_VALUE} AS valor, {PARAMETER.format(norm('par_metro'))} AS medida
    FROM raw_cli, range(1, 13) m(i)) WHERE medida IS NOT NULL GROUP BY 1, 2, 3""")
sql("expand_weeks", ["aire"], """
SELECT ano, departamento, municipio, CAST(w AS INTEGER) AS semana FROM aire, range(1, 53) s(w)""")
sql("surveillance_weekly", ["vsp"], f"SELECT {COUNTED} FROM vsp")
sql("climate_weekly", ["clima"], f"""
SELECT CAST(semana AS INTEGER) AS semana, departamento, municipio, {half_up('temperatura_promedio', 6)} AS temperatura_promedio,
    {half_up('precipitacion_promedio', 6)} AS precipitacion_promedio, latitud, longitud FROM clima""")
_AIR = f"""ano, departamento, municipio, {half_up('calidad_aire_promedio', 6)} AS calidad_aire_promedio,
    {half_up('temperatura_promedio_aire', 6)} AS temperatura_promedio_aire, latitud_aire, longitud_aire"""
sql("air_quality_yearly", ["aire"], f"SELECT {_AIR} FROM aire")
sql("air_quality_weekly", ["aire"], f"SELECT {_AIR}, CAST(w AS INTEGER) AS semana FROM aire, range(1, 53) s(w)")
sql("providers_per_place", ["hosp"], "SELECT * FROM hosp")

# ---- reports over the master table -------------------------------------------------------

CASES = "CAST(coalesce(sum(casos_totales), 0) AS BIGINT)"


def _top(columns: str, n: int) -> str:
    return f"SELECT {columns}, {CASES} AS casos FROM maestro GROUP BY {columns} ORDER BY casos DESC, {columns} LIMIT {n}"


METRICS = ["temperatura_promedio", "precipitacion_promedio", "calidad_aire_promedio", "cantidad_hospitales"]
PARTS["anual"] = (["maestro"], f"SELECT ano, {CASES} AS casos FROM maestro GROUP BY 1")
PARTS["cambio"] = (["anual"], f"""
SELECT p.ano AS from_year, u.ano AS to_year, p.casos AS from_cases, u.casos AS to_cases,
    CASE WHEN p.casos > 0 THEN {half_even('(u.casos - p.casos) * 100.0 / p.casos', 1)} END AS pct,
    CASE WHEN u.casos > p.casos THEN 'sube' WHEN u.casos < p.casos THEN 'baja' ELSE 'igual' END AS direction
FROM (SELECT * FROM anual ORDER BY ano LIMIT 1) p, (SELECT * FROM anual ORDER BY ano DESC LIMIT 1) u WHERE p.ano < u.ano""")
PARTS["semanas"] = (["maestro"], f"""
SELECT ano, semana, printf('%d-W%02d', ano, semana) AS label, {CASES} AS casos FROM maestro GROUP BY ano, semana
ORDER BY ano DESC, semana DESC LIMIT 52""")
PARTS["por_enf_ano"] = (["maestro"], f"SELECT enfermedad, ano, {CASES} AS casos FROM maestro GROUP BY 1, 2")
PARTS["cambio_enf"] = (["por_enf_ano"], """
SELECT enfermedad, count(*) AS anos, min(ano) AS from_year, max(ano) AS to_year, arg_min(casos, ano) AS from_cases,
    arg_max(casos, ano) AS to_cases FROM por_enf_ano GROUP BY 1""")
PARTS["tendencia"] = (["por_enf_ano"], """
SELECT d.enfermedad, y.ano, coalesce(p.casos, 0) AS casos
FROM (SELECT enfermedad FROM por_enf_ano GROUP BY 1 ORDER BY sum(casos) DESC, enfermedad LIMIT 5) d
CROSS JOIN (SELECT DISTINCT ano FROM por_enf_ano) y LEFT JOIN por_enf_ano p ON p.enfermedad = d.enfermedad AND p.ano = y.ano""")

sql("kpi_totals", ["maestro"], f"SELECT count(*) AS filas, {CASES} AS casos, count(DISTINCT municipio) AS municipios FROM maestro")
sql("outbreak_distribution", ["maestro"], "SELECT brote, count(*) AS filas FROM maestro GROUP BY 1")
sql("disease_stats", ["maestro"], f"SELECT enfermedad, {CASES} AS casos, count(*) AS filas FROM maestro GROUP BY 1")
sql("metric_means", ["maestro"], "SELECT " + ", ".join(f"{half_even(f'avg({m})', 2)} AS {m}" for m in METRICS) + " FROM maestro")
sql("weekly_cases", ["semanas"], "SELECT ano, semana, label, casos FROM semanas")
sql("top_municipalities", ["maestro"], _top("departamento, municipio", 10))
for _name, _column in {
    "top_region": "departamento", "top_disease": "enfermedad", "top_year": "ano", "top_municipality": "municipio",
}.items():
    sql(_name, ["maestro"], _top(_column, 1))
sql("yearly_variation", ["cambio"], "SELECT * FROM cambio")
sql("trend_top5", ["tendencia"], "SELECT enfermedad, ano, casos FROM tendencia")
sql("geo_pivot", ["maestro"], f"""
SELECT departamento, {CASES} AS casos, """ + ", ".join(
    f"CAST(coalesce(sum(casos_totales) FILTER (enfermedad = '{d}'), 0) AS BIGINT) AS {d.lower()}"
    for d in ("DENGUE", "ZIKA", "CHIKUNGUNYA")
) + " FROM maestro WHERE enfermedad IN ('DENGUE', 'ZIKA', 'CHIKUNGUNYA') GROUP BY 1")
sql("geo_share_of_max", ["maestro"], f"""
, r AS (SELECT departamento, {CASES} AS casos FROM maestro GROUP BY 1)
SELECT departamento, casos, {half_up('casos / greatest(1, (SELECT max(casos) FROM r))', 6)} AS share FROM r""")
sql("fastest_growing", ["cambio_enf"], f"""
SELECT enfermedad, {half_even('(to_cases - from_cases) * 100.0 / from_cases', 1)} AS pct, from_year, to_year
FROM cambio_enf WHERE anos >= 2 AND from_cases > 0
ORDER BY (to_cases - from_cases) * 100.0 / from_cases DESC, enfermedad LIMIT 1""")
sql("compare_categories", ["cambio_enf", "maestro"], f"""
, r AS (SELECT enfermedad, departamento, {CASES} AS casos FROM maestro GROUP BY 1, 2),
t AS (SELECT enfermedad, departamento, row_number() OVER (PARTITION BY enfermedad ORDER BY casos DESC, departamento) AS rn,
    CAST(sum(casos) OVER (PARTITION BY enfermedad) AS BIGINT) AS total FROM r)
SELECT enfermedad, total AS casos, departamento AS top_departamento, from_year, to_year,
    CASE WHEN anos >= 2 AND from_cases > 0 THEN {half_even('(to_cases - from_cases) * 100.0 / from_cases', 1)} END AS pct,
    CASE WHEN anos < 2 THEN NULL WHEN to_cases > from_cases THEN 'sube' WHEN to_cases < from_cases THEN 'baja' ELSE 'igual' END AS direction
FROM t JOIN cambio_enf USING (enfermedad) WHERE rn = 1""")
sql("facet_values", ["maestro"], "\nUNION ".join(
    f"SELECT '{c}' AS facet, CAST({c} AS VARCHAR) AS value FROM maestro" for c in ("departamento", "enfermedad", "ano", "brote")
))
_ORDER = "ano, semana, departamento, municipio, enfermedad"
sql("page_rows", ["maestro"], f"SELECT {MASTER_COLUMNS} FROM maestro ORDER BY {_ORDER} LIMIT 200 OFFSET 100")
sql("page_rows_unique_key", [], """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem ORDER BY ALL LIMIT 100 OFFSET 5000""")
sql("filtered_page", ["seleccion"], f"""
SELECT {MASTER_COLUMNS}, (SELECT count(*) FROM seleccion) AS filtered_total FROM seleccion ORDER BY {_ORDER} LIMIT 20 OFFSET 5""")
for _name in ("page_rows_deep", "page_rows_seek"):
    sql(_name, ["maestro"], f"SELECT {MASTER_COLUMNS} FROM maestro ORDER BY {_ORDER} LIMIT 50 OFFSET 1500")
_LATER = "ano >= 1996 AND brote = 'NO'"
sql("page_rows_filtered_deep", ["maestro"], f"SELECT {MASTER_COLUMNS} FROM maestro WHERE {_LATER} ORDER BY {_ORDER} LIMIT 40 OFFSET 700")


def _record(fields: dict[str, str]) -> str:
    return "{" + ", ".join(f"'{name}': {value}" for name, value in fields.items()) + "}"


def _list(record: str, order: str, rows: str) -> str:
    return f"(SELECT coalesce(list({record} ORDER BY {order}), []) FROM ({rows}))"


_MASTER_NAMES = [c.strip() for c in MASTER_COLUMNS.split(",")]


def _page_json(name: str, offset: int, limit: int, where: str) -> str:
    rows = f"SELECT * FROM maestro WHERE {where} ORDER BY {_ORDER} LIMIT {limit} OFFSET {offset}"
    payload = _record({
        "columns": str(_MASTER_NAMES), "rows": _list(_record({c: c for c in _MASTER_NAMES}), _ORDER, rows), "offset": str(offset),
        "limit": str(limit), "filtered_total": f"(SELECT count(*) FROM maestro WHERE {where})",
    })
    return f"SELECT '{name}' AS page, CAST(to_json({payload}) AS VARCHAR) AS payload"


sql("page_json", ["maestro"], "\nUNION ALL ".join([_page_json("plain", 40, 25, "true"), _page_json("later", 300, 10, _LATER), _page_json("behind", 10**9, 5, "true")]))


def _forecast(by: str) -> str:
    keys, lead = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    group = f"GROUP BY {by}" if by else ""
    return f"""
, w AS (SELECT {keys}ano, semana, CAST(coalesce(sum(casos_totales), 0) AS DOUBLE) AS casos,
    row_number() OVER ({lead}ORDER BY ano DESC, semana DESC) AS rn
    FROM maestro WHERE semana BETWEEN 1 AND 52 GROUP BY {keys}ano, semana),
f AS (SELECT {keys}count(*) AS n, avg(casos) AS media, arg_max(casos, rn) AS primero, arg_min(casos, rn) AS ultimo,
    arg_min(ano * 52 + semana - 1, rn) AS fin FROM w WHERE rn <= 12 {group} HAVING count(*) > 0)
SELECT {keys}CAST((fin + i) // 52 AS INTEGER) AS ano, CAST((fin + i) % 52 + 1 AS INTEGER) AS semana,
    printf('%d-W%02d', (fin + i) // 52, (fin + i) % 52 + 1) AS label,
    CAST(greatest(0, round_even(ultimo + i * CASE WHEN n < 2 THEN 0 ELSE (ultimo - primero) / (n - 1) END, 0)) AS BIGINT) AS casos,
    CAST(round_even(media, 0) AS BIGINT) AS promedio_reciente, CAST(n AS INTEGER) AS semanas_usadas
FROM f, range(1, 5) s(i)"""


sql("forecast_4w", ["maestro"], _forecast(""))
sql("forecast_4w_by_disease", ["maestro"], _forecast("enfermedad"))

_SENTENCES = f"""
SELECT 1 AS position, CASE direction
    WHEN 'sube' THEN printf('En el periodo %d–%d, los casos subieron %.1f%%.', from_year, to_year, pct)
    WHEN 'baja' THEN printf('En el periodo %d–%d, los casos bajaron %.1f%%.', from_year, to_year, abs(pct))
    ELSE printf('En el periodo %d–%d, los casos se mantuvieron estables.', from_year, to_year) END AS text
FROM cambio WHERE pct IS NOT NULL
UNION ALL SELECT 2, 'La enfermedad con más casos en la selección actual es ' || enfermedad || '.' FROM ({_top('enfermedad', 1)})
UNION ALL SELECT 3, 'El departamento con más casos en la selección actual es ' || departamento || '.' FROM ({_top('departamento', 1)})"""
sql("insights", ["maestro", "cambio"], _SENTENCES)
_SUMMARY = f"""
SELECT 'kpi' AS block, 'filas' AS label, CAST(count(*) AS DOUBLE) AS value FROM maestro
UNION ALL SELECT 'kpi', 'casos', {CASES} FROM maestro
UNION ALL SELECT 'kpi', 'municipios', count(DISTINCT municipio) FROM maestro
UNION ALL SELECT 'brote', brote, count(*) FROM maestro GROUP BY brote
UNION ALL SELECT 'enfermedad_casos', enfermedad, {CASES} FROM maestro GROUP BY enfermedad
UNION ALL SELECT 'enfermedad_filas', enfermedad, count(*) FROM maestro GROUP BY enfermedad
UNION ALL SELECT 'semana', label, casos FROM semanas
UNION ALL SELECT 'top_municipio', departamento || ' / ' || municipio, casos FROM ({_top('departamento, municipio', 10)})
""" + "\n".join(f"UNION ALL SELECT 'promedio', '{m}', {half_even(f'avg({m})', 2)} FROM maestro" for m in METRICS) + f"""
UNION ALL SELECT 'top_enfermedad', enfermedad, casos FROM ({_top('enfermedad', 1)})
UNION ALL SELECT 'top_departamento', departamento, casos FROM ({_top('departamento', 1)})
UNION ALL SELECT 'variacion', direction, pct FROM cambio
UNION ALL SELECT 'variacion', unnest(['from_year', 'to_year', 'from_cases', 'to_cases']), unnest([from_year, to_year, from_cases, to_cases]) FROM cambio
UNION ALL SELECT 'tendencia', ano || '|' || enfermedad, casos FROM tendencia
UNION ALL SELECT 'frase', text, position FROM ({_SENTENCES})"""
_BLOCKS = ["maestro", "semanas", "cambio", "tendencia"]
sql("summary_long", _BLOCKS, _SUMMARY)


def _of_selection(text: str) -> str:
    """The same statement over the selection instead of the whole table."""
    for part in ("anual", "cambio", "semanas", "por_enf_ano", "tendencia"):
        text = re.sub(rf"(FROM|JOIN) {part}\b", rf"\1 {part}_sel", text)
    return re.sub(r"FROM maestro\b", "FROM seleccion", text)


for _part in ("anual", "cambio", "semanas", "por_enf_ano", "tendencia"):
    _reads, _text = PARTS[_part]
    PARTS[f"{_part}_sel"] = (["seleccion" if r == "maestro" else f"{r}_sel" for r in _reads], _of_selection(_text))
sql("summary_filtered", ["seleccion", "semanas_sel", "cambio_sel", "tendencia_sel"], _of_selection(_SUMMARY))


def _summary_json(name: str, rows: str) -> str:
    def per(column: str) -> str:
        return f"SELECT {column}, {CASES} AS casos, count(*) AS filas FROM {rows} GROUP BY {column}"

    def top(column: str) -> str:
        return f"(SELECT {column} FROM ({per(column)}) ORDER BY casos DESC, {column} LIMIT 1)"

    years = f"(SELECT ano, {CASES} AS casos FROM {rows} GROUP BY ano)"
    change = f"""(SELECT p.ano AS from_year, u.ano AS to_year, p.casos AS from_cases, u.casos AS to_cases,
        CASE WHEN p.casos > 0 THEN {half_even('(u.casos - p.casos) * 100.0 / p.casos', 1)} END AS pct,
        CASE WHEN u.casos > p.casos THEN 'sube' WHEN u.casos < p.casos THEN 'baja' ELSE 'igual' END AS direction
        FROM (SELECT * FROM {years} ORDER BY ano LIMIT 1) p, (SELECT * FROM {years} ORDER BY ano DESC LIMIT 1) u WHERE p.ano < u.ano)"""
    texts = f"""SELECT 1 AS position, CASE direction
            WHEN 'sube' THEN printf('En el periodo %d–%d, los casos subieron %.1f%%.', from_year, to_year, pct)
            WHEN 'baja' THEN printf('En el periodo %d–%d, los casos bajaron %.1f%%.', from_year, to_year, abs(pct))
            ELSE printf('En el periodo %d–%d, los casos se mantuvieron estables.', from_year, to_year) END AS text FROM {change} WHERE pct IS NOT NULL
        UNION ALL SELECT 2, 'La enfermedad con más casos en la selección actual es ' || x || '.' FROM (SELECT {top('enfermedad')} AS x) WHERE x IS NOT NULL
        UNION ALL SELECT 3, 'El departamento con más casos en la selección actual es ' || x || '.' FROM (SELECT {top('departamento')} AS x) WHERE x IS NOT NULL"""
    series = f"""SELECT name, sum(casos) AS casos, list(casos ORDER BY ano) AS data FROM (
        SELECT d.enfermedad AS name, y.ano, coalesce(p.casos, 0) AS casos
        FROM (SELECT enfermedad FROM ({per('enfermedad')}) ORDER BY casos DESC, enfermedad LIMIT 5) d CROSS JOIN (SELECT ano FROM {years}) y
        LEFT JOIN (SELECT enfermedad, ano, {CASES} AS casos FROM {rows} GROUP BY 1, 2) p ON p.enfermedad = d.enfermedad AND p.ano = y.ano) GROUP BY name"""
    weeks = f"SELECT ano, semana, {CASES} AS casos FROM {rows} GROUP BY ano, semana ORDER BY ano DESC, semana DESC LIMIT 52"
    places = f"SELECT departamento, municipio, {CASES} AS casos FROM {rows} GROUP BY 1, 2 ORDER BY casos DESC, departamento, municipio LIMIT 10"
    payload = _record({
        "filtered_total_rows": f"(SELECT count(*) FROM {rows})", "total_cases": f"(SELECT {CASES} FROM {rows})",
        "municipios": f"(SELECT count(DISTINCT municipio) FROM {rows})",
        "brote_counts": f"(SELECT coalesce(map_from_entries(list((flag, filas) ORDER BY flag)), MAP {{}}) FROM (SELECT coalesce(brote, 'null') AS flag, count(*) AS filas FROM {rows} GROUP BY 1))",
        "disease_stats": _list(_record({c: c for c in ("enfermedad", "casos", "filas")}), "casos DESC, enfermedad", per("enfermedad")),
        "weekly_cases": _list(_record({"label": "printf('%d-W%02d', ano, semana)", "casos": "casos"}), "ano, semana", weeks),
        "top_municipios": _list(_record({c: c for c in ("departamento", "municipio", "casos")}), "casos DESC, departamento, municipio", places),
        "metrics": f"(SELECT {_record({m: half_even(f'avg({m})', 2) for m in METRICS})} FROM {rows})",
        "top_enfermedad": top("enfermedad"), "top_departamento": top("departamento"),
        "variation": f"(SELECT {_record({c: c for c in ('from_year', 'to_year', 'from_cases', 'to_cases', 'pct', 'direction')})} FROM {change})",
        "insights": _list("text", "position", texts),
        "trend": _record({"labels": _list("CAST(ano AS VARCHAR)", "ano", f"SELECT ano FROM {years}"), "series": _list(_record({"name": "name", "data": "data"}), "casos DESC, name", series)}),
    })
    return f"SELECT '{name}' AS rows, CAST(to_json({payload}) AS VARCHAR) AS payload"


sql("summary_json", ["maestro", "seleccion"], "\nUNION ALL ".join(
    [_summary_json("all", "maestro"), _summary_json("selection", "seleccion"), _summary_json("none", "(SELECT * FROM maestro WHERE ano < 0)")]
))

# ---- conversations -----------------------------------------------------------------------

sql("last_user_turn", ["preguntas"], """
SELECT conv_id, turn, text FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM preguntas WHERE role = 'user' AND text <> '')
WHERE rn = 1""")
sql("context_window", ["preguntas"], """
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS position, turn,
    CASE WHEN role = 'assistant' THEN 'assistant' ELSE 'user' END AS role, text
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM preguntas)
WHERE rn <= 16 AND text <> ''""")


def _has(*groups: str) -> str:
    return "(" + " AND ".join("(" + " OR ".join(f"contains(k, '{w}')" for w in g.split("|")) + ")" for g in groups) + ")"


sql("tag_intents", ["preguntas"], f"""
, t AS (SELECT conv_id, turn, {key('text')} AS k FROM preguntas WHERE role = 'user' AND text <> ''),
d AS (SELECT *, CASE WHEN {_has('DENGUE')} THEN 'DENGUE' WHEN {_has('ZIKA')} THEN 'ZIKA' WHEN {_has('CHIKUNGUNYA')} THEN 'CHIKUNGUNYA'
    WHEN {_has('CHIK')} THEN 'CHIKUNGUNYA' WHEN {_has('DENG')} THEN 'DENGUE' WHEN {_has('ZIK')} THEN 'ZIKA' END AS disease FROM t)
SELECT conv_id, turn, disease, CASE WHEN k = '' THEN 'empty'
    WHEN disease IS NOT NULL AND {_has('SINTOM')} THEN 'symptoms'
    WHEN disease IS NOT NULL AND {_has('PREVEN|EVIT')} THEN 'prevention'
    WHEN disease IS NOT NULL AND {_has('CUANDO', 'CONSULT|URGEN|MEDIC')} THEN 'warning_signs'
    WHEN disease IS NOT NULL AND {_has('QUE ES|EXPLIC')} THEN 'definition'
    WHEN disease IS NOT NULL AND {_has('TRANSM|CONTAG')} THEN 'transmission'
    WHEN {_has('DIFEREN|COMPAR')} AND ({_has('DENG', 'ZIK')} OR {_has('DENG', 'CHIK')} OR {_has('ZIK', 'CHIK')}) THEN 'compare'
    WHEN {_has('CREC', 'ENFERMEDAD')} THEN 'fastest_growing' WHEN {_has('MAS', 'AFECT')} THEN 'top_region'
    WHEN {_has('RESUMEN')} THEN 'summary' WHEN {_has('AYUDA|PREGUNT|QUE PUEDO')} THEN 'help'
    WHEN {_has('ENFERMEDAD', 'COMUN')} THEN 'top_disease' WHEN {_has('ANO', 'MAS', 'CASO')} THEN 'top_year'
    WHEN {_has('TOTAL|CUANT', 'CASO')} THEN 'total_cases' WHEN {_has('TOTAL|CUANT', 'DATO|REGIST|FILAS')} THEN 'total_rows'
    WHEN disease IS NOT NULL THEN 'about_disease' ELSE 'other' END AS intent,
    {_has('PREDIC|PRONOST|FORECAST|PROXIM|PROYECC|ESTIM')} AS wants_forecast
FROM d""")
