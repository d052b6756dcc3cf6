"""Staging and intermediate models: strict types, renames, the diagnosis category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climora import schemas
from climora.functions.parsing import leading_text, whole_number


def stage_daily_climate(raw: DataFrame) -> DataFrame:
    """Typed daily climate with the day as ``date_day``; a value that does not cast is an error."""
    return raw.select(
        *[
            F.col(f.name).cast(f.dataType).alias("date_day" if f.name == "date" else f.name)
            for f in schemas.DAILY_CLIMATE
        ]
    )


def stage_admissions(raw: DataFrame) -> DataFrame:
    """Typed admissions; the stay becomes whole days, halves going to the even neighbour."""
    stay = F.col("length_of_stay")
    if not isinstance(raw.schema["length_of_stay"].dataType, T.IntegralType):
        stay = whole_number(stay.cast("double"))
    return raw.select(
        F.col("aih_number").cast("string"),
        F.col("municipality_residence_code").cast("string"),
        F.col("admission_date").cast("date"),
        F.col("primary_diagnosis").cast("string"),
        F.col("total_aih_value").cast("double"),
        stay.cast("int").alias("length_of_stay"),
    )


def enrich_admissions(staged: DataFrame) -> DataFrame:
    """Adds the three-character diagnosis category."""
    return staged.withColumn("icd_group", leading_text(F.col("primary_diagnosis"), 3))
