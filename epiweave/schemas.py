"""Explicit schemas of the raw sources and of the master table."""

from __future__ import annotations

from pyspark.sql import types as T

from epiweave.fixed import MONTHS


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# Counts and periods arrive as text and are converted with try_cast, so that a bad cell
# becomes null instead of failing the job.
SURVEILLANCE_RAW = _struct(
    ano=S, semana=S, departamento_ocurrencia=S, municipio_ocurrencia=S, nombre_evento=S, conteo=S,
)
CLIMATE_RAW = T.StructType(
    _struct(departamento=S, municipio=S, par_metro=S, ao=S, latitud=D, longitud=D).fields
    + [T.StructField(m, D, True) for m in MONTHS]
)
AIR_RAW = _struct(
    a_o=S, nombre_del_departamento=S, nombre_del_municipio=S, variable=S, promedio=D,
    latitud=D, longitud=D,
)
PROVIDERS_RAW = _struct(departamentoprestadordesc=S, municipioprestadordesc=S, nombreprestador=S)

MASTER = _struct(
    ano=I, semana=I, departamento=S, municipio=S, enfermedad=S, casos_totales=L,
    temperatura_promedio=D, precipitacion_promedio=D, calidad_aire_promedio=D, vacunacion=S,
    cantidad_hospitales=L, latitud=D, longitud=D, brote=S,
)
MASTER_KEYS = ["ano", "semana", "departamento", "municipio", "enfermedad"]
