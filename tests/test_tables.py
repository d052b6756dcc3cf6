from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climora import schemas
from climora.operators import changes
from climora.operators.admissions import clean_admissions, keep_last
from climora.params import AdmissionsRun, ClimateRun
from climora.plans import jobs
from climora.sources import sinks, tables
from climora.sources.archives import pack_archive, scan_station_files
from test_archives import ROW, member, station_file


def climate_rows(spark, *rows):
    full = [(s, d, "N", st, None, None, t, None, None, None, None) for s, d, st, t in rows]
    return spark.createDataFrame(full, schemas.DAILY_CLIMATE)


def content(spark, path):
    rows = tables.read_daily_climate(spark, path).collect()
    return sorted((r.station_code, r.date.day, r.avg_temp) for r in rows)


def day(n):
    return date(2024, 5, n)


@pytest.mark.parametrize("by", [sinks.CLIMATE_BY_DATE, sinks.CLIMATE_BY_MONTH, sinks.CLIMATE_BY_STATE_MONTH])
def test_layouts_read_back_alike(spark, tmp_path, by):
    rows = climate_rows(spark, ("A", day(1), "PR", 1.0), ("B", day(2), "SC", 2.0))
    assert sinks.write_daily_climate(rows, str(tmp_path / "c"), by) == 2
    back = tables.read_daily_climate(spark, str(tmp_path / "c"))
    assert back.schema == schemas.DAILY_CLIMATE
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_partition_column_is_in_the_folder_only(spark, tmp_path):
    sinks.write_daily_climate(climate_rows(spark, ("A", day(1), "PR", 1.0)), str(tmp_path / "c"))
    folders = [p.name for p in (tmp_path / "c").iterdir() if p.is_dir()]
    assert folders == ["date=2024-05-01"]
    assert "date" not in spark.read.parquet(str(tmp_path / "c" / folders[0])).columns


def test_rerun_replaces_its_own_days_only(spark, tmp_path):
    path = str(tmp_path / "c")
    sinks.write_daily_climate(climate_rows(spark, ("A", day(1), "PR", 1.0), ("A", day(2), "PR", 2.0)), path)
    for _ in range(2):
        sinks.write_daily_climate(climate_rows(spark, ("A", day(2), "PR", 9.0)), path)
    assert content(spark, path) == [("A", 1, 1.0), ("A", 2, 9.0)]


def test_no_rows_leave_the_table_untouched(spark, tmp_path):
    path = str(tmp_path / "c")
    sinks.write_daily_climate(climate_rows(spark, ("A", day(1), "PR", 1.0)), path)
    assert sinks.write_daily_climate(climate_rows(spark), path) == 0
    assert content(spark, path) == [("A", 1, 1.0)]


def test_merge_keeps_other_stations_of_a_day(spark, tmp_path):
    for by in (sinks.CLIMATE_BY_DATE, sinks.CLIMATE_BY_MONTH, sinks.CLIMATE_BY_STATE_MONTH):
        path = str(tmp_path / by[0])
        first = climate_rows(spark, ("A", day(1), "PR", 1.0), ("B", day(1), "PR", 2.0))
        changes.merge_daily_climate(spark, first, path, by)
        fresh = climate_rows(spark, ("A", day(1), "PR", 7.0), ("A", day(2), "PR", 8.0))
        for _ in range(2):
            changes.merge_daily_climate(spark, fresh, path, by)
        assert content(spark, path) == [("A", 1, 7.0), ("A", 2, 8.0), ("B", 1, 2.0)]


@pytest.mark.parametrize("by", [sinks.CLIMATE_BY_DATE, sinks.CLIMATE_BY_MONTH, sinks.CLIMATE_BY_STATE_MONTH])
def test_a_later_window_or_fewer_stations_lose_nothing(spark, tmp_path, by):
    path = str(tmp_path / "c")
    month = [("A", day(n), "PR", float(n)) for n in range(1, 32)] + [("B", day(n), None, 0.5) for n in (1, 2)]
    assert changes.merge_daily_climate(spark, climate_rows(spark, *month), path, by) == 33
    again = climate_rows(spark, *[("A", day(n), "PR", 90.0) for n in range(15, 25)])
    assert changes.merge_daily_climate(spark, again, path, by) == 10
    assert changes.merge_daily_climate(spark, climate_rows(spark), path, by) == 0
    want = [("A", n, 90.0 if 15 <= n < 25 else float(n)) for n in range(1, 32)] + [("B", 1, 0.5), ("B", 2, 0.5)]
    assert content(spark, path) == want


def test_a_station_that_changes_its_state_is_in_one_folder(spark, tmp_path):
    path, by = str(tmp_path / "c"), sinks.CLIMATE_BY_STATE_MONTH
    changes.merge_daily_climate(spark, climate_rows(spark, ("A", day(1), None, 1.0), ("B", day(1), "SC", 2.0)), path, by)
    changes.merge_daily_climate(spark, climate_rows(spark, ("A", day(1), "PR", 7.0), ("B", day(1), "PR", 8.0)), path, by)
    assert content(spark, path) == [("A", 1, 7.0), ("B", 1, 8.0)]


@pytest.mark.parametrize("by", [sinks.CLIMATE_BY_DATE, sinks.CLIMATE_BY_MONTH, sinks.CLIMATE_BY_STATE_MONTH])
def test_a_range_reads_its_folders_only(spark, tmp_path, by):
    path = str(tmp_path / "c")
    sinks.write_daily_climate(climate_rows(spark, ("A", day(1), "PR", 1.0), ("A", date(2023, 1, 1), "PR", 2.0)), path, by)
    rows = tables.read_daily_climate(spark, path, day(1), day(3), by)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan
    assert [r.avg_temp for r in rows.collect()] == [1.0]


def test_history_gives_way_to_the_fresh_window(spark):
    history = climate_rows(spark, ("A", day(1), "PR", 1.0), ("A", day(2), "PR", 2.0))
    fresh = climate_rows(spark, ("A", day(2), "PR", 5.0), ("B", day(2), "PR", 6.0))
    got = tables.prefer_fresh(history, fresh).collect()
    assert sorted((r.station_code, r.date.day, r.avg_temp) for r in got) == [
        ("A", 1, 1.0), ("A", 2, 5.0), ("B", 2, 6.0),
    ]


def admissions(spark, *rows):
    full = [(k, "410690", d, "J189", v, 1.0) for k, d, v in rows]
    fields = [f for f in schemas.ADMISSIONS if f.name != "admission_month"]
    return spark.createDataFrame(full, T.StructType(fields))


def stored(spark, path):
    rows = tables.read_admissions(spark, path).collect()
    return sorted(((r.aih_number, r.admission_month, r.total_aih_value) for r in rows), key=str)


def test_admission_month_and_undated_records(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = admissions(spark, ("1", date(2024, 1, 31), 1.0), ("2", None, 2.0))
    assert sinks.write_admissions(rows, path) == 2
    assert stored(spark, path) == [("1", date(2024, 1, 1), 1.0), ("2", None, 2.0)]


def test_merge_of_corrections(spark, tmp_path):
    path = str(tmp_path / "a")
    jan, feb, mar = date(2024, 1, 10), date(2024, 2, 10), date(2024, 3, 10)
    sinks.write_admissions(
        admissions(spark, ("1", jan, 1.0), ("2", jan, 2.0), ("3", feb, 3.0), ("4", None, 4.0)), path
    )
    # 1 changes its value, 3 leaves February empty, 4 gets a date, 5 is new, late for January.
    updates = admissions(spark, ("1", jan, 9.0), ("3", mar, 3.5), ("4", mar, 4.5), ("5", jan, 5.0))
    want = [
        ("1", date(2024, 1, 1), 9.0), ("2", date(2024, 1, 1), 2.0), ("3", date(2024, 3, 1), 3.5),
        ("4", date(2024, 3, 1), 4.5), ("5", date(2024, 1, 1), 5.0),
    ]
    for _ in range(2):
        changes.merge_admissions(spark, updates, path)
        assert stored(spark, path) == want


def land(spark, path, competence, *rows):
    full = [(k, "410690", d, diagnosis, "10", "1") for k, d, diagnosis in rows]
    frame = spark.createDataFrame(
        full, "N_AIH string, MUNIC_RES string, DT_INTER string, DIAG_PRINC string, VAL_TOT string, DIAS_PERM string"
    ).coalesce(1)
    frame.write.mode("overwrite").parquet(f"{path}/state=PR/competence={competence}")


def test_admissions_job(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    land(spark, landing, "2024-01", ("1", "20240105", "J189"), ("2", "20240106", "J189"), ("1", "20240107", "J449"))
    land(spark, landing, "2024-02", ("2", "20240106", "J209"), ("3", "20240210", "I219"))
    run = AdmissionsRun((2024, 1), (2024, 3))
    assert jobs.ingest_admissions(spark, landing, out, run) == 2
    rows = tables.read_admissions(spark, out).collect()
    assert sorted((r.aih_number, r.primary_diagnosis, r.admission_date.day) for r in rows) == [
        ("1", "J449", 7), ("2", "J209", 6),
    ]
    # A later competence holds one January admission: January keeps its other rows.
    land(spark, landing, "2024-03", ("9", "20240120", "J111"))
    assert jobs.ingest_admissions(spark, landing, out, run) == 3
    assert tables.read_admissions(spark, out).filter("admission_month = DATE'2024-01-01'").count() == 3
    # Nothing published in the range: nothing is written.
    assert jobs.ingest_admissions(spark, landing, out, AdmissionsRun((2030, 1), (2030, 2))) == 0
    assert tables.read_admissions(spark, out).count() == 3


def test_a_window_that_moves_on_keeps_earlier_records(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    land(spark, landing, "2022-01", *[(str(n), "20220105", "J189") for n in range(20)])
    land(spark, landing, "2022-02", ("late", "20220131", "J189"), ("20", "20220210", "J189"))
    assert jobs.ingest_admissions(spark, landing, out, AdmissionsRun((2022, 1), (2022, 2))) == 22
    jobs.ingest_admissions(spark, landing, out, AdmissionsRun((2022, 2), (2022, 3)))
    months = [r.admission_month.month for r in tables.read_admissions(spark, out).collect()]
    assert (months.count(1), months.count(2)) == (21, 1)
    assert jobs.ingest_admissions(spark, landing, out, AdmissionsRun((2022, 1), (2022, 2), states=("SC",))) == 0


def test_a_month_without_rows_is_emptied_in_the_mart(spark, tmp_path):
    path = str(tmp_path / "mart")
    days = [date(2024, 1, 5), date(2024, 2, 5), date(2024, 3, 5)]
    climate = spark.createDataFrame(
        [(d, "A", 1.0, 0.0, 2.0, 50.0, 0.0) for d in days],
        "fk_date date, fk_station string, avg_temp double, min_temp double, max_temp double,"
        " avg_relative_humidity double, total_precipitation double",
    )
    admitted = spark.createDataFrame(
        [], "aih_number string, fk_date date, fk_municipality string, admission_count int, total_aih_value double, length_of_stay int, icd_group string"
    )
    mapping = spark.createDataFrame([], schemas.STATION_MAPPING)
    jobs.refresh_mart(admitted, climate, mapping, path, (2024, 1), (2024, 3))
    jobs.refresh_mart(admitted, climate.filter("fk_date <> DATE'2024-02-05'"), mapping, path, (2024, 2), (2024, 3))
    assert sorted(r.date_day for r in tables.read_mart(spark, path).collect()) == [days[0], days[2]]


def test_competences_prune_folders(spark, tmp_path):
    land(spark, str(tmp_path), "2024-01", ("1", "20240105", "J189"))
    land(spark, str(tmp_path), "2024-02", ("2", "20240105", "J189"))
    rows = tables.read_landed_admissions(spark, str(tmp_path), ["2024-02"], ["PR"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "competence" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [(r.N_AIH, r.state, r.competence, r.source_row) for r in rows.collect()] == [("2", "PR", "2024-02", 0)]


def test_record_order_survives_several_files(spark, tmp_path):
    path = str(tmp_path / "landing")
    rows = spark.range(4000).select(
        (F.col("id") % 97).cast("string").alias("N_AIH"), F.lit("410690").alias("MUNIC_RES"),
        F.lit("20240105").alias("DT_INTER"), F.lit("J189").alias("DIAG_PRINC"),
        F.col("id").cast("string").alias("VAL_TOT"), F.lit("1").alias("DIAS_PERM"),
        F.lit("PR").alias("state"), F.when(F.col("id") < 100, "2024-01").otherwise("2024-02").alias("competence"),
        F.col("id").alias("place"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sinks.land_admissions(rows.repartition(7), path, "place")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(list((tmp_path / "landing/state=PR/competence=2024-02").glob("*.parquet"))) > 1
    kept = keep_last(tables.read_landed_admissions(spark, path), ("N_AIH",)).collect()
    want = {str(k): str(max(i for i in range(4000) if i % 97 == k)) for k in range(97)}
    assert {r.N_AIH: r.VAL_TOT for r in kept} == want


def test_changed_competences(spark, tmp_path):
    land(spark, str(tmp_path), "2024-01", ("1", "20240105", "J189"), ("2", "20240105", "J189"))
    land(spark, str(tmp_path), "2024-02", ("3", "20240105", "J189"))
    before = changes.fingerprints(tables.read_landed_admissions(spark, str(tmp_path)))
    before.write.parquet(str(tmp_path / "_manifest"))
    manifest = spark.read.parquet(str(tmp_path / "_manifest"))
    land(spark, str(tmp_path), "2024-01", ("2", "20240105", "J189"), ("1", "20240105", "J189"))
    land(spark, str(tmp_path), "2024-02", ("3", "20240105", "J449"))
    land(spark, str(tmp_path), "2024-03", ("4", "20240105", "J449"))
    now = changes.fingerprints(tables.read_landed_admissions(spark, str(tmp_path)))
    got = changes.changed_competences(now, manifest).collect()
    assert sorted(tuple(r) for r in got) == [("PR", "2024-02"), ("PR", "2024-03")]


def test_order_of_one_key_changes_the_fingerprint(spark, tmp_path):
    prints = []
    for rows in (("1", "20240105", "J189"), ("2", "20240105", "J189"), ("1", "20240105", "J449")), (
        ("1", "20240105", "J449"), ("2", "20240105", "J189"), ("1", "20240105", "J189"),
    ):
        land(spark, str(tmp_path), "2024-01", *rows)
        prints.append(changes.fingerprints(tables.read_landed_admissions(spark, str(tmp_path))).collect())
    assert prints[0][0].row_count == prints[1][0].row_count == 3
    assert prints[0][0].checksum != prints[1][0].checksum


def test_an_older_competence_that_comes_last_does_not_win(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    land(spark, landing, "2024-01", ("1", "20240105", "J189"), (None, "20240105", "J189"), ("2", "20240109", "J189"))
    land(spark, landing, "2024-02", ("1", "20240106", "J449"), (None, "20240206", "J449"))
    for month in (2, 1, 1):
        jobs.ingest_admissions(spark, landing, out, AdmissionsRun((2024, month), (2024, month)))
        found = {(r.aih_number, r.primary_diagnosis) for r in tables.read_admissions(spark, out).collect()}
        assert found == {("1", "J449"), (None, "J449")} | ({("2", "J189")} if month == 1 else set())


def test_incremental_job_equals_a_rebuild(spark, tmp_path):
    landing, out, manifest = (str(tmp_path / n) for n in ("landing", "out", "manifest"))

    def holds(*pairs):
        assert sorted(jobs.update_admissions(spark, landing, out, manifest)) == [("PR", p) for p in pairs]
        whole = clean_admissions(tables.read_landed_admissions(spark, landing), ("410690",), r"^J\d{2}")
        rows = tables.read_admissions(spark, out)
        assert sorted(map(str, rows.drop("admission_month").collect())) == sorted(map(str, whole.collect()))

    land(spark, landing, "2024-01", ("1", "20240105", "J189"), ("2", "20240106", "J189"), (None, "bad", "J189"))
    land(spark, landing, "2024-02", ("1", "20240107", "J449"), ("3", "20240210", "J209"))
    holds("2024-01", "2024-02")
    holds()
    # 1 is back to its version of January, 3 is not in the scope any more, 4 is new.
    land(spark, landing, "2024-02", ("3", "20240210", "I219"), ("4", "20240211", "J209"))
    holds("2024-02")
    # The versions of one number change places; the record without a number goes.
    land(spark, landing, "2024-01", ("1", "20240105", "J189"), ("1", "20240105", "J111"), ("2", "20240106", "J189"))
    holds("2024-01")
    land(spark, landing, "2024-01", ("1", "20240105", "J111"), ("1", "20240105", "J189"), ("2", "20240106", "J189"))
    holds("2024-01")
    # A folder of which nothing is left.
    land(spark, landing, "2024-02")
    holds("2024-02")
    assert {r.admission_month for r in tables.read_admissions(spark, out).collect()} == {date(2024, 1, 1)}


def test_all_jobs_end_to_end(spark, tmp_path):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(40)]
    text = station_file([(d.strftime("%Y/%m/%d"), *ROW) for d in days])
    (tmp_path / "zips").mkdir()
    (tmp_path / "zips" / "2024.zip").write_bytes(pack_archive([(member(year=2024), text)]))
    land(spark, str(tmp_path / "landing"), "2024-01", ("1", "20240105", "J189"), ("2", "20240105", "J449"), ("3", "20240220", "J449"))
    (tmp_path / "municipalities.csv").write_text(
        "ibge_code,municipality_name,state,latitude,longitude\n410690,Curitiba,PR,-25.4284,-49.2733\n"
    )
    (tmp_path / "mapping.csv").write_text("municipality_ibge_code,station_code\n410690,Z042\n")
    at = lambda name: str(tmp_path / name)
    run = ClimateRun(date(2024, 1, 1), date(2024, 1, 31), stations=("Z042",))
    assert jobs.ingest_climate(spark, at("zips"), at("climate"), run) == 31
    assert jobs.ingest_climate(spark, at("nowhere"), at("climate"), run) == 0
    (tmp_path / "files" / "2024").mkdir(parents=True)
    (tmp_path / "files" / "2024" / member(year=2024)).write_bytes(text)
    by_month = dict(scan=scan_station_files, by=sinks.CLIMATE_BY_MONTH)
    assert jobs.ingest_climate(spark, at("files"), at("monthly"), run, **by_month) == 31
    by_day, by_month = (tables.read_daily_climate(spark, at(n)) for n in ("climate", "monthly"))
    assert by_day.exceptAll(by_month).count() == 0
    assert jobs.ingest_admissions(spark, at("landing"), at("admissions"), AdmissionsRun((2024, 1), (2024, 1))) == 3
    sources = jobs.Sources(at("climate"), at("admissions"), at("municipalities.csv"), at("mapping.csv"))
    built = jobs.build_models(spark, sources, at("marts"), as_of=date(2024, 6, 1))
    results = jobs.check_models(built, at("checks"), date(2024, 6, 1))
    assert results.count() == 50 and results.filter("NOT passed").count() == 0
    assert spark.read.parquet(at("checks")).count() == 50
    top = spark.sql(
        "SELECT date_day, daily_admission_count, avg_temp FROM mart_climate_health_correlation"
        " WHERE daily_admission_count > 0 ORDER BY date_day"
    ).collect()
    assert [tuple(r) for r in top] == [(date(2024, 1, 5), 2, 11.6), (date(2024, 2, 20), 1, None)]
    assert spark.table("dim_location").first().region == "Sul"
    assert spark.table("dim_date").agg(F.max("date_day")).first()[0] == date(2025, 5, 31)


def test_runs_report_their_stages(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    land(spark, landing, "2024-01", ("1", "20240105", "J189"), ("2", "20240106", "J189"), ("1", "20240107", "J449"), ("3", "20240107", "I219"))
    full = [("9", "999999", "20240105", "J189", "1", "1")]
    spark.createDataFrame(full, "N_AIH string, MUNIC_RES string, DT_INTER string, DIAG_PRINC string, VAL_TOT string, DIAS_PERM string").write.mode(
        "append"
    ).parquet(f"{landing}/state=PR/competence=2024-01")
    run = AdmissionsRun((2024, 1), (2024, 1))
    for _ in range(2):
        assert jobs.run_admissions(spark, landing, out, run) == changes.AdmissionCounts(5, 4, 3, 2, 2)
    nothing = jobs.run_admissions(spark, landing, out, AdmissionsRun((2030, 1), (2030, 1)))
    assert nothing == changes.AdmissionCounts(0, 0, 0, 0, 0)
    text = station_file([("2019/09/01", *ROW), ("2019/09/01", *ROW), ("2019/09/02", *ROW), ("bad", *ROW)])
    (tmp_path / "zips").mkdir()
    (tmp_path / "zips" / "2019.zip").write_bytes(pack_archive([(member(), text)]))
    span = ClimateRun(date(2019, 9, 1), date(2019, 9, 2), ("Z042",))
    assert jobs.run_climate(spark, str(tmp_path / "zips"), str(tmp_path / "climate"), span) == jobs.ClimateReport(3, 0, 2)
    assert jobs.run_climate(spark, str(tmp_path / "none"), str(tmp_path / "climate"), span) == jobs.ClimateReport()
