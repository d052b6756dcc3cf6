"""Explicit schemas of every stored table. Codes are text, always."""

from __future__ import annotations

from pyspark.sql import types as T

# Landed admission records: all measures as text, one folder per state and competence.
RAW_ADMISSIONS = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("N_AIH", "MUNIC_RES", "DT_INTER", "DIAG_PRINC", "VAL_TOT", "DIAS_PERM")
    ]
    + [T.StructField("state", T.StringType()), T.StructField("competence", T.StringType())]
)

# Source column names of an admission record and their names downstream.
ADMISSION_COLUMNS = {
    "N_AIH": "aih_number",
    "MUNIC_RES": "municipality_residence_code",
    "DT_INTER": "admission_date",
    "DIAG_PRINC": "primary_diagnosis",
    "VAL_TOT": "total_aih_value",
    "DIAS_PERM": "length_of_stay",
}

ADMISSIONS = T.StructType(
    [
        T.StructField("aih_number", T.StringType()),
        T.StructField("municipality_residence_code", T.StringType()),
        T.StructField("admission_date", T.DateType()),
        T.StructField("primary_diagnosis", T.StringType()),
        T.StructField("total_aih_value", T.DoubleType()),
        T.StructField("length_of_stay", T.DoubleType()),
        T.StructField("admission_month", T.DateType()),
    ]
)

# Source field names of one hourly weather record.
HOURLY_FIELDS = (
    "CD_ESTACAO",
    "DC_NOME",
    "UF",
    "VL_LATITUDE",
    "VL_LONGITUDE",
    "DT_MEDICAO",
    "TEM_INS",
    "TEM_MAX",
    "TEM_MIN",
    "UMD_INS",
    "CHUVA",
)

DAILY_CLIMATE = T.StructType(
    [
        T.StructField("station_code", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("avg_temp", T.DoubleType()),
        T.StructField("min_temp", T.DoubleType()),
        T.StructField("max_temp", T.DoubleType()),
        T.StructField("avg_relative_humidity", T.DoubleType()),
        T.StructField("total_precipitation", T.DoubleType()),
    ]
)

# Which landed folder a stored admission came from; NULL where it was stored without a job.
VERSION = ("competence", "state")
VERSIONED_ADMISSIONS = T.StructType(
    [
        *[f for f in ADMISSIONS if f.name != "admission_month"],
        *[T.StructField(name, T.StringType()) for name in VERSION],
        ADMISSIONS["admission_month"],
    ]
)

MUNICIPALITIES = T.StructType(
    [
        T.StructField("ibge_code", T.StringType()),
        T.StructField("municipality_name", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

STATION_MAPPING = T.StructType(
    [
        T.StructField("municipality_ibge_code", T.StringType()),
        T.StructField("station_code", T.StringType()),
    ]
)

MART = T.StructType(
    [
        T.StructField("date_day", T.DateType()),
        T.StructField("station_code", T.StringType()),
        T.StructField("fk_municipality", T.StringType()),
        T.StructField("avg_temp", T.DoubleType()),
        T.StructField("min_temp", T.DoubleType()),
        T.StructField("max_temp", T.DoubleType()),
        T.StructField("avg_relative_humidity", T.DoubleType()),
        T.StructField("total_precipitation", T.DoubleType()),
        T.StructField("daily_admission_count", T.LongType()),
        T.StructField("daily_total_aih_value", T.DoubleType()),
        T.StructField("avg_length_of_stay", T.DoubleType()),
    ]
)
