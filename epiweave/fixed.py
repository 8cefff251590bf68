"""Tables, patterns and constants that results depend on.

Everything here is data. Functions elsewhere take these as default arguments, so another
country, disease list or pollutant list is a parameter and not a code change.
"""

# Diseases kept from the surveillance source.
TARGET_DISEASES = ["DENGUE", "ZIKA", "CHIKUNGUNYA"]

# Month column names, January first.
MONTHS = ["ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic"]
WEEKS_PER_YEAR = 52
WEEKS_PER_MONTH = 4

# Climate parameter substrings and the measure each one feeds.
CLIMATE_PARAMETERS = {
    "TEMPERATURA MEDIA": "temperatura_promedio",
    "PRECIPITACION": "precipitacion_promedio",
}

# Air-station variables.
POLLUTANTS = ["PM2.5", "PM10", "O3", "NO2", "SO2", "CO", "PST"]
AIR_TEMPERATURES = ["TAire", "TAire10", "TAire2"]

# Mangled characters and the letter each one stands for.
MANGLED_LETTERS = {
    "┴": "A", "═": "I", "Ë": "O", "Ð": "N", "Ý": "I", "¾": "O", "ß": "A",
    "×": "O", "¡": "A", "¢": "E", "£": "I", "¤": "O",
}

# Accented capitals and their plain letter.
ACCENTED_CAPITALS = {"Á": "A", "É": "E", "Í": "I", "Ó": "O", "Ú": "U", "Ñ": "N"}
UMLAUT_CAPITALS = {"Ü": "U"}

# Accented small letters folded in column headers.
HEADER_LETTERS = {"á": "a", "é": "e", "í": "i", "ó": "o", "ú": "u", "ñ": "n"}

# Place-name clean-up patterns, applied in this order to upper-case text.
PLACE_PATTERNS = [
    (r"^\*\s*", ""),
    (r"\.\s*MUNICIPIO\s*DESCONOCIDO", ""),
    (r"BOGOTA\s*,?\s*D\.?\s*C\.?", "BOGOTA"),
    (r"SANTA MARTHA", "SANTA MARTA"),
    (r"CARTAGENA DE INDIAS", "CARTAGENA"),
    (r"\s+", " "),
]

# Short region names and the official name used across sources.
REGION_NAMES = {
    "VALLE": "VALLE DEL CAUCA",
    "NORTE SANTANDER": "NORTE DE SANTANDER",
    "BOGOTA": "BOGOTA D.C.",
    "GUAJIRA": "LA GUAJIRA",
    "SAN ANDRES": "SAN ANDRES, PROVIDENCIA Y SANTA CATALINA",
}

# Map-name aliases, keyed by comparison key.
REGION_ALIASES = {
    "BOGOTA DC": "BOGOTA",
    "BOGOTA D C": "BOGOTA",
    "DISTRITO CAPITAL DE BOGOTA": "BOGOTA",
    "NORTE DE SANTANDER": "NORTH SANTANDER",
    "SAN ANDRES PROVIDENCIA Y SANTA CATALINA": "SAN ANDRES Y PROVIDENCIA",
    "ARCHIPIELAGO DE SAN ANDRES PROVIDENCIA Y SANTA CATALINA": "SAN ANDRES Y PROVIDENCIA",
}
MIN_CONTAINED_NAME = 5

# Earth radius and default imputation radius, in kilometres.
EARTH_RADIUS_KM = 6371.0
IMPUTE_RADIUS_KM = 50.0

# Plausible range of each measure, both ends included; None is open.
SANITY_RANGES = {
    "temperatura_promedio": (0, 45),
    "precipitacion_promedio": (0, 1200),
    "calidad_aire_promedio": (0, 500),
    "latitud": (-5, 15),
    "longitud": (-82, -65),
    "casos_totales": (0, None),
}

# Outbreak label.
OUTBREAK_PERCENTILE = 0.75
OUTBREAK_YES = "SI"
OUTBREAK_NO = "NO"
VACCINATION_CONSTANT = "NO_REPORTA"

# Decimals of the measures in the master table.
MASTER_DECIMALS = {
    "temperatura_promedio": 2,
    "precipitacion_promedio": 2,
    "calidad_aire_promedio": 2,
    "latitud": 5,
    "longitud": 5,
}

# Measures averaged in the summary.
SUMMARY_METRICS = [
    "temperatura_promedio", "precipitacion_promedio", "calidad_aire_promedio",
    "cantidad_hospitales",
]

# Sizes of reports, pages and exports.
WEEKLY_TAIL = 52
TOP_MUNICIPALITIES = 10
TOP_TREND_SERIES = 5
FORECAST_HISTORY = 12
FORECAST_STEPS = 4
CONTEXT_TURNS = 16
PAGE_MAX_ROWS = 5000
EXPORT_MAX_ROWS = 300000
SOURCE_PAGE_ROWS = 50000

# Direction words and insight sentences.
DIRECTION_UP = "sube"
DIRECTION_DOWN = "baja"
DIRECTION_SAME = "igual"
INSIGHT_UP = "En el periodo %d–%d, los casos subieron %.1f%%."
INSIGHT_DOWN = "En el periodo %d–%d, los casos bajaron %.1f%%."
INSIGHT_SAME = "En el periodo %d–%d, los casos se mantuvieron estables."
INSIGHT_DISEASE = "La enfermedad con más casos en la selección actual es %s."
INSIGHT_REGION = "El departamento con más casos en la selección actual es %s."

# Prefixes that name a disease when its full name is absent.
DISEASE_PREFIXES = {"CHIK": "CHIKUNGUNYA", "DENG": "DENGUE", "ZIK": "ZIKA"}

# Question intents in order of precedence. Each rule is a list of groups;
# a rule applies when every group has at least one keyword in the text.
DISEASE_INTENTS = [
    ("symptoms", [["SINTOM"]]),
    ("prevention", [["PREVEN", "EVIT"]]),
    ("warning_signs", [["CUANDO"], ["CONSULT", "URGEN", "MEDIC"]]),
    ("definition", [["QUE ES", "EXPLIC"]]),
    ("transmission", [["TRANSM", "CONTAG"]]),
]
GENERAL_INTENTS = [
    ("compare", [["DIFEREN", "COMPAR"], ["DENG", "ZIK"], ["DENG", "CHIK"], ["ZIK", "CHIK"]]),
    ("fastest_growing", [["CREC"], ["ENFERMEDAD"]]),
    ("top_region", [["MAS"], ["AFECT"]]),
    ("summary", [["RESUMEN"]]),
    ("help", [["AYUDA", "PREGUNT", "QUE PUEDO"]]),
    ("top_disease", [["ENFERMEDAD"], ["COMUN"]]),
    ("top_year", [["ANO"], ["MAS"], ["CASO"]]),
    ("total_cases", [["TOTAL", "CUANT"], ["CASO"]]),
    ("total_rows", [["TOTAL", "CUANT"], ["DATO", "REGIST", "FILAS"]]),
]
FORECAST_KEYWORDS = ["PREDIC", "PRONOST", "FORECAST", "PROXIM", "PROYECC", "ESTIM"]
