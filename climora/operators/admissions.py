"""Raw admission records to clean ones: filter, keep the last version, type."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from climora.functions.parsing import compact_date, tolerant_double
from climora.schemas import ADMISSION_COLUMNS

# Chronological order of record versions: competence first, then place in the landed files.
VERSION_ORDER = ("competence", "source_file", "source_row")


def filter_by_municipality(
    records: DataFrame, codes: tuple[str, ...] | list[str] | DataFrame, column: str = "MUNIC_RES"
) -> DataFrame:
    """Records of the wanted municipalities: a literal list, or a table with ``ibge_code``."""
    if isinstance(codes, DataFrame):
        wanted = codes.select(F.col("ibge_code").alias(column)).distinct()
        return records.join(wanted, column, "left_semi")
    return records.filter(is_in_municipalities(codes, column))


def is_in_municipalities(codes, column: str = "MUNIC_RES") -> Column:
    return F.col(column).cast("string").isin(*codes)


def literal_prefix(pattern: str) -> str:
    """Leading text that every match of an anchored pattern must start with ('' if unsure)."""
    if "|" in pattern or "(?" in pattern:
        return ""
    head = re.match(r"\^?([A-Za-z0-9]*)(.?)", pattern)
    text, follower = head.group(1), head.group(2)
    return text[:-1] if follower and follower in "?*{" else text


def matches_diagnosis(pattern: str, column: str = "DIAG_PRINC") -> Column:
    """The diagnosis starts with a match of ``pattern``; unknown, so not kept, where it is NULL.

    The literal prefix is stated again because Parquet can skip data on it, not on a pattern. A
    ``coalesce`` around the predicate would keep both from reaching the scan.
    """
    code = F.col(column).cast("string")
    hit = code.rlike(f"^(?:{pattern})")
    prefix = literal_prefix(pattern)
    if prefix:
        hit = code.startswith(prefix) & hit
    return hit


def filter_by_diagnosis(
    records: DataFrame, pattern: str, column: str = "DIAG_PRINC"
) -> DataFrame:
    return records.filter(matches_diagnosis(pattern, column))


def keep_last(
    records: DataFrame, key: tuple[str, ...], order: tuple[str, ...] = VERSION_ORDER
) -> DataFrame:
    """The last version per key; records without a key count as one.

    ``row_number() = 1`` is also applied to each map task's own rows before the shuffle, so a key
    with very many versions sends one row per task, not all of them.
    """
    latest_first = W.partitionBy(*key).orderBy(*[F.desc_nulls_last(c) for c in order])
    ranked = records.withColumn("version_rank", F.row_number().over(latest_first))
    return ranked.filter(F.col("version_rank") == 1).drop("version_rank")


def select_and_type(records: DataFrame, *carried: str) -> DataFrame:
    """The six source columns under their downstream names; bad dates and numbers become NULL."""
    typed = {
        "admission_date": compact_date,
        "total_aih_value": tolerant_double,
        "length_of_stay": tolerant_double,
    }
    return records.select(
        *[
            typed.get(name, lambda c: c)(F.col(source)).alias(name)
            for source, name in ADMISSION_COLUMNS.items()
        ],
        *carried,
    )


def clean_admissions(
    records: DataFrame, codes: tuple[str, ...] | list[str] | DataFrame, pattern: str, *carried: str
) -> DataFrame:
    """Filter, then keep the last version, then type; ``carried`` columns stay as they are.

    The filters come first on purpose: a later version that no longer matches them does not
    displace an earlier one that does.
    """
    wanted = filter_by_diagnosis(filter_by_municipality(records, codes), pattern)
    return select_and_type(keep_last(wanted, ("N_AIH",)), *carried)


def stage_counts(records: DataFrame, codes: tuple[str, ...], pattern: str) -> DataFrame:
    """Per competence: records read, in the municipalities, with the diagnosis, and kept."""
    in_scope = is_in_municipalities(codes)
    relevant = in_scope & matches_diagnosis(pattern)
    read = records.groupBy("competence").agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(in_scope).alias("municipality_rows"),
        F.count_if(relevant).alias("diagnosis_rows"),
    )
    narrow = records.filter(relevant).select("N_AIH", *VERSION_ORDER)
    kept = (
        keep_last(narrow, ("N_AIH",))
        .groupBy("competence")
        .agg(F.count(F.lit(1)).alias("kept_rows"))
    )
    return read.join(kept, "competence", "left").select(
        "competence",
        "raw_rows",
        "municipality_rows",
        "diagnosis_rows",
        F.coalesce("kept_rows", F.lit(0)).cast("long").alias("kept_rows"),
    )
