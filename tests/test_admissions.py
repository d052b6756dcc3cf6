from datetime import date

import pytest
from pyspark.sql import functions as F

from climora.operators.admissions import (
    clean_admissions,
    filter_by_diagnosis,
    filter_by_municipality,
    keep_last,
    literal_prefix,
    select_and_type,
    stage_counts,
)
from climora.schemas import ADMISSION_COLUMNS

RAW = (
    "N_AIH string, MUNIC_RES string, DT_INTER string, DIAG_PRINC string, VAL_TOT string,"
    " DIAS_PERM string, competence string, source_file string, source_row long"
)
PATTERN = r"^J\d{2}"


def raw(spark, *rows):
    """Rows given as dicts over one ordinary record."""
    base = dict(N_AIH="1", MUNIC_RES="410690", DT_INTER="20240115", DIAG_PRINC="J189",
                VAL_TOT="1500.50", DIAS_PERM="5", competence="2024-01", source_file="f")
    full = [tuple({**base, "source_row": i, **r}.values()) for i, r in enumerate(rows)]
    order = [*base, "source_row"]
    return spark.createDataFrame(full, RAW).select(*order)


def column(frame, name):
    return sorted((r[name] for r in frame.collect()), key=str)


def test_municipality(spark):
    rows = raw(spark, {}, {"MUNIC_RES": "410480"}, {"MUNIC_RES": None})
    assert column(filter_by_municipality(rows, ["410690"]), "MUNIC_RES") == ["410690"]
    table = spark.createDataFrame([("410690",), ("410690",)], "ibge_code string")
    assert filter_by_municipality(rows, table).count() == 1
    assert filter_by_municipality(raw(spark), ["410690"]).count() == 0


def test_numeric_codes_compare_as_text(spark):
    rows = spark.createDataFrame([(410690,), (410480,)], "MUNIC_RES int")
    assert filter_by_municipality(rows, ("410690",)).count() == 1


def test_diagnosis(spark):
    rows = raw(spark, *[{"DIAG_PRINC": d} for d in ("J189", "I219", "J449", None, "J1", "XJ18", "j18")])
    assert column(filter_by_diagnosis(rows, PATTERN), "DIAG_PRINC") == ["J189", "J449"]
    # A pattern without an anchor still has to match at the start.
    assert column(filter_by_diagnosis(rows, r"J\d{2}|I2"), "DIAG_PRINC") == ["I219", "J189", "J449"]


@pytest.mark.parametrize(
    "pattern, prefix",
    [(r"^J\d{2}", "J"), ("J4?", "J"), ("J*", ""), ("A|B", ""), ("(?i)J", ""), ("[JK]", ""), ("J18", "J18"), ("J{0,1}8", "")],
)
def test_literal_prefix(pattern, prefix):
    assert literal_prefix(pattern) == prefix


def test_diagnosis_prefix_reaches_parquet(spark, tmp_path):
    raw(spark, {}).write.parquet(str(tmp_path / "t"))
    rows = filter_by_diagnosis(spark.read.parquet(str(tmp_path / "t")), PATTERN)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(DIAG_PRINC,J)" in plan


def test_typing(spark):
    rows = select_and_type(
        raw(spark, {}, {"N_AIH": "2", "DT_INTER": "20240230", "VAL_TOT": "x", "DIAS_PERM": "x"})
    )
    assert rows.columns == list(ADMISSION_COLUMNS.values())
    assert [tuple(r) for r in rows.orderBy("aih_number").collect()] == [
        ("1", "410690", date(2024, 1, 15), "J189", 1500.5, 5.0),
        ("2", "410690", None, "J189", None, None),
    ]
    assert select_and_type(raw(spark)).columns == list(ADMISSION_COLUMNS.values())


def test_the_last_version_is_kept(spark):
    rows = raw(
        spark,
        {"N_AIH": "1", "VAL_TOT": "a"}, {"N_AIH": "2"}, {"N_AIH": "1", "VAL_TOT": "b"},
        {"N_AIH": "3", "competence": "2024-02", "VAL_TOT": "new", "source_row": 0},
        {"N_AIH": "3", "competence": "2024-01", "VAL_TOT": "old", "source_row": 9},
        {"N_AIH": None}, {"N_AIH": None},
    )
    got = {r.N_AIH: r.VAL_TOT for r in keep_last(rows, ("N_AIH",)).collect()}
    assert got == {"1": "b", "2": "1500.50", "3": "new", None: "1500.50"}


def test_a_key_with_most_rows_is_thinned_before_the_shuffle(spark):
    plan = keep_last(raw(spark, {}), ("N_AIH",))._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert plan.index("WindowGroupLimit", shuffle) > shuffle
    assert "row_number(), 1, Partial" in plan


def test_hot_key_against_brute_force(spark):
    rows = (
        spark.range(3000)
        .select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("N_AIH"),
            F.format_string("2024-%02d", F.col("id") % 12 + 1).alias("competence"),
            F.lit("f").alias("source_file"),
            F.col("id").alias("source_row"),
        )
        .repartition(5)
    )
    best = {}
    for r in rows.collect():
        best[r.N_AIH] = max(best.get(r.N_AIH, ("", "", -1)), (r.competence, r.source_file, r.source_row))
    got = {r.N_AIH: (r.competence, r.source_file, r.source_row) for r in keep_last(rows, ("N_AIH",)).collect()}
    assert got == best


def test_clean_filters_before_it_keeps_the_last(spark):
    rows = raw(
        spark,
        {"N_AIH": "1", "competence": "2024-01"},
        {"N_AIH": "1", "competence": "2024-02", "DIAG_PRINC": "I219"},
        {"N_AIH": "2", "MUNIC_RES": "410480"},
    )
    got = clean_admissions(rows, ("410690",), PATTERN).collect()
    assert [(r.aih_number, r.primary_diagnosis) for r in got] == [("1", "J189")]


def test_stage_counts(spark):
    rows = raw(
        spark,
        {"N_AIH": "1"}, {"N_AIH": "1"}, {"N_AIH": "2", "MUNIC_RES": "9"}, {"N_AIH": "3", "DIAG_PRINC": None},
        {"N_AIH": "1", "competence": "2024-02"}, {"N_AIH": "4", "competence": "2024-03", "MUNIC_RES": "9"},
    )
    got = stage_counts(rows, ("410690",), PATTERN).orderBy("competence").collect()
    assert [tuple(r) for r in got] == [
        ("2024-01", 4, 3, 2, 0), ("2024-02", 1, 1, 1, 1), ("2024-03", 1, 0, 0, 0),
    ]
