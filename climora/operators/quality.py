"""Declared data checks: failing rows per check, and one result table for many checks.

NULL passes every check but ``not_null``, and forms a group of its own in
``unique_combination``. The failure count is the number of rows the check's own table of failing
rows has: rows for ``not_null``, ``relationships`` and ``expression``; values or key tuples for the
others.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Models = Mapping[str, DataFrame]

# Columns of grouped rows: rows of the model, rows of a parent, and which columns the group is of.
_N, _PARENTS, _SET = "check_rows", "check_parents", "check_set"


@dataclass(frozen=True)
class Check:
    """One declared check.

    ``rule`` is the violated-row predicate of a row-wise check. A check on groups names the columns it groups by (``keys``),
    tells the groups that fail from their keys and size ``n`` (``bad``), and where its keys are looked up (``parent``).
    """

    model: str
    column: str
    test: str
    rule: Column | None = None
    failing: Callable[[Models], DataFrame] | None = None
    keys: tuple[str, ...] = ()
    bad: Column | None = None
    parent: tuple[str, str] | None = None


def not_null(model: str, column: str) -> Check:
    return Check(model, column, "not_null", rule=F.col(column).isNull())


def expression(model: str, column: str, condition: str) -> Check:
    """Rows for which the SQL condition is false; an unknown condition passes."""
    return Check(model, column, "expression_is_true", rule=~F.expr(condition))


def accepted_values(model: str, column: str, values: tuple) -> Check:
    def failing(models: Models) -> DataFrame:
        offending = models[model].filter(~F.col(column).isin(*values))
        return offending.groupBy(F.col(column).alias("value")).agg(
            F.count(F.lit(1)).alias("n_records")
        )

    bad = ~F.col(column).isin(*values) & (F.col(_N) > 0)
    return Check(model, column, "accepted_values", failing=failing, keys=(column,), bad=bad)


def unique(model: str, column: str) -> Check:
    def failing(models: Models) -> DataFrame:
        known = models[model].filter(F.col(column).isNotNull())
        return known.groupBy(column).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")

    return Check(model, column, "unique", failing=failing, keys=(column,), bad=F.col(column).isNotNull() & (F.col(_N) > 1))


def unique_combination(model: str, *columns: str) -> Check:
    def failing(models: Models) -> DataFrame:
        return (
            models[model]
            .groupBy(*columns)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter("n_records > 1")
        )

    return Check(
        model, ",".join(columns), "unique_combination_of_columns", failing=failing, keys=columns, bad=F.col(_N) > 1
    )


def relationships(model: str, column: str, parent: str, parent_column: str) -> Check:
    """Rows whose key has no parent. Equal keys are folded before the join, their count kept."""

    def failing(models: Models) -> DataFrame:
        children = (
            models[model]
            .filter(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("key"))
            .agg(F.count(F.lit(1)).alias("n_records"))
        )
        parents = models[parent].select(F.col(parent_column).alias("key")).distinct()
        return children.join(parents, "key", "left_anti")

    bad = F.col(column).isNotNull() & (F.col(_PARENTS) == 0)
    return Check(model, column, "relationships", failing=failing, keys=(column,), bad=bad, parent=(parent, parent_column))


def failing_rows(check: Check, models: Models) -> DataFrame:
    """The rows (or values, or keys) that violate one check."""
    if check.failing is not None:
        return check.failing(models)
    return models[check.model].filter(check.rule)


def _results(frame: DataFrame, model: str, checks: list[Check], failures: list[Column]) -> DataFrame:
    """One row per check from a frame of one row, ``frame.agg(failures)``."""
    counts = frame.agg(*[f.cast("long").alias(f"f{i}") for i, f in enumerate(failures)])
    results = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(c.column).alias("column"),
            F.lit(c.test).alias("test"),
            F.col(f"f{i}").alias("failures"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*results)))


def _grouped(model: str, checks: list[Check], models: Models) -> DataFrame:
    """All checks of a model in one pass over it: one aggregation with a grouping set for each key that is checked.

    Keys of parents come in as rows of their own, which count in ``check_parents`` only, so that a group without any
    has no parent. Row-wise rules are counted in the set of no columns.
    """
    rows = models[model].withColumn(_N, F.lit(1))
    own = F.col(_N) == 1
    ruled = [c for c in checks if c.rule is not None]
    sets = list(dict.fromkeys([c.keys for c in checks if c.rule is None] + [()] * bool(ruled)))
    columns = list(dict.fromkeys(k for keys in sets for k in keys))
    number = {keys: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in keys) for keys in sets}
    for c in checks:
        if c.parent is not None:
            name, column = c.parent
            kind = models[model].schema[c.column].dataType
            rows = rows.unionByName(
                models[name].select(F.col(column).cast(kind).alias(c.column), F.lit(0).alias(_N)), allowMissingColumns=True
            )
    groups = rows.groupingSets([[F.col(k) for k in keys] for keys in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias(_SET), F.sum(_N).alias(_N), F.count_if(~own).alias(_PARENTS),
        *[F.count_if(own & c.rule).alias(f"check_{i}") for i, c in enumerate(ruled)],
    )
    failures, place = [], 0
    for c in checks:
        here = F.col(_SET) == number[c.keys]
        if c.rule is not None:
            failures.append(F.coalesce(F.max(F.when(here, F.col(f"check_{place}"))), F.lit(0)))
            place += 1
        elif c.parent is not None:
            failures.append(F.coalesce(F.sum(F.when(here & c.bad, F.col(_N))), F.lit(0)))
        else:
            failures.append(F.count_if(here & c.bad))
    return _results(groups, model, checks, failures)


def run_checks(checks: list[Check], models: Models) -> DataFrame:
    """One result row per check: ``model, column, test, failures, passed``. Each model is read once for all its checks."""
    by_model: dict[str, list[Check]] = {}
    for check in checks:
        by_model.setdefault(check.model, []).append(check)
    parts = [
        _results(models[model], model, group, [F.count_if(c.rule) for c in group])
        if all(c.rule is not None for c in group)
        else _grouped(model, group, models)
        for model, group in by_model.items()
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)


def store_results(results: DataFrame, path: str, run_date: date) -> None:
    """Keep the results of a run as a queryable table; a repeated run replaces its own day."""
    (
        results.withColumn("run_date", F.lit(run_date))
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .parquet(path)
    )


# Accepted values of the declared checks.
MONTHS = tuple(range(1, 13))
SEASONS = ("Summer", "Autumn", "Winter", "Spring")
REGIONS = ("Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul")

# Columns that must not be NULL, and single-column keys, per model.
REQUIRED = {
    "dim_date": ("date_day", "year", "month", "day", "day_of_week", "month_name", "season"),
    "dim_location": ("ibge_code", "region"),
    "dim_weather_station": ("station_code",),
    "fct_respiratory_admissions": (
        "aih_number",
        "fk_date",
        "fk_municipality",
        "admission_count",
        "icd_group",
    ),
    "fct_daily_climate": ("fk_date", "fk_station"),
    "mart_climate_health_correlation": ("date_day", "daily_admission_count"),
    "int_datasus__admissions_enriched": ("aih_number", "icd_group"),
    "stg_inmet__daily_climate": ("station_code", "date_day"),
    "stg_datasus__admissions": (
        "aih_number",
        "municipality_residence_code",
        "admission_date",
        "primary_diagnosis",
    ),
    "municipalities": ("ibge_code",),
    "municipality_station_mapping": ("municipality_ibge_code",),
}
KEYS = {
    "dim_date": "date_day",
    "dim_location": "ibge_code",
    "dim_weather_station": "station_code",
    "fct_respiratory_admissions": "aih_number",
    "int_datasus__admissions_enriched": "aih_number",
    "stg_datasus__admissions": "aih_number",
    "municipalities": "ibge_code",
    "municipality_station_mapping": "municipality_ibge_code",
}


def declared_checks() -> list[Check]:
    """The 50 checks on the staging, intermediate, mart and reference tables."""
    return [
        *[not_null(model, column) for model, columns in REQUIRED.items() for column in columns],
        *[unique(model, column) for model, column in KEYS.items()],
        accepted_values("dim_date", "month", MONTHS),
        accepted_values("dim_date", "season", SEASONS),
        accepted_values("dim_location", "region", REGIONS),
        accepted_values("fct_respiratory_admissions", "admission_count", (1,)),
        relationships("fct_respiratory_admissions", "fk_date", "dim_date", "date_day"),
        relationships("fct_respiratory_admissions", "fk_municipality", "dim_location", "ibge_code"),
        relationships("fct_daily_climate", "fk_date", "dim_date", "date_day"),
        relationships("fct_daily_climate", "fk_station", "dim_weather_station", "station_code"),
        expression("fct_respiratory_admissions", "length_of_stay", "length_of_stay >= 0"),
        expression("fct_daily_climate", "min_temp", "min_temp <= max_temp"),
        expression("stg_datasus__admissions", "primary_diagnosis", "primary_diagnosis like 'J%'"),
        unique_combination("fct_daily_climate", "fk_date", "fk_station"),
        unique_combination("stg_inmet__daily_climate", "station_code", "date_day"),
    ]
