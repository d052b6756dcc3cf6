import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climora import schemas
from climora.operators import changelog
from climora.operators.admissions import clean_admissions
from climora.plans import jobs
from climora.sources import snapshots, tables

KEY = ("k",)
SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.DoubleType()), T.StructField("part", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(k, v, p) for k, (v, p) in rows.items()], SCHEMA)


def content(rows):
    return {r.k: (repr(r.v), r.part) for r in rows.collect()}


def plain(rows):
    return {k: (repr(v), p) for k, (v, p) in rows.items()}


def test_every_kind_of_change(spark):
    before = {"same": (1.0, "x"), "nan": (float("nan"), None), "moves": (2.0, "x"), "goes": (3.0, "y"), "value": (4.0, "y"), None: (None, "x")}
    after = {"same": (1.0, "x"), "nan": (float("nan"), None), "moves": (2.0, "y"), "value": (None, "y"), "new": (5.0, "z"), None: (0.5, "x")}
    log = changelog.row_changes(frame(spark, before), frame(spark, after), KEY)
    assert log.columns == ["op", "k", "old", "new"]
    found = {r.k: (r.op, r.old and tuple(r.old), r.new and tuple(r.new)) for r in log.collect()}
    assert found == {
        "moves": ("update", (2.0, "x"), (2.0, "y")), "goes": ("delete", (3.0, "y"), None), "value": ("update", (4.0, "y"), (None, "y")),
        "new": ("insert", None, (5.0, "z")), None: ("update", (None, "x"), (0.5, "x")),
    }
    assert content(changelog.apply_changes(frame(spark, before), log, KEY)) == plain(after)
    assert changelog.row_changes(frame(spark, before), frame(spark, before), KEY).count() == 0


def test_plan_joins_once_on_the_key(spark):
    one, other = frame(spark, {"a": (1.0, "x")}), frame(spark, {"b": (1.0, "x")})
    plan = changelog.row_changes(one, other, KEY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FullOuter") >= 1 and "NestedLoop" not in plan


@pytest.mark.parametrize("seed", range(2))
def test_a_log_leads_to_every_state(spark, tmp_path, seed):
    rng = random.Random(seed)
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    assert changelog.append_changes(spark, path, log, SCHEMA, KEY) == 0  # nothing published yet
    state, replica = {}, frame(spark, {})
    for _ in range(4):
        for k in rng.sample(range(30), 12):
            if rng.random() < 0.4:
                state.pop(str(k), None)
            else:
                state[str(k)] = (float(rng.randrange(3)), rng.choice("xyz"))
        held = snapshots.snapshot(spark, path)
        gone = set(held.folders) if held else set()
        snapshots.replace_folders(frame(spark, state), path, ("part",), emptied=gone)
        done = changelog.logged_until(spark, log)
        changed = changelog.append_changes(spark, path, log, SCHEMA, KEY)
        step = changelog.read_changes(spark, log, SCHEMA, KEY, after=done)
        assert step.count() == changed
        replica = changelog.apply_changes(spark.createDataFrame(replica.collect(), SCHEMA), step, KEY)
        assert content(replica) == plain(state)
        assert content(changelog.replayed(changelog.read_changes(spark, log, SCHEMA, KEY), KEY, SCHEMA.names)) == plain(state)
        assert changelog.append_changes(spark, path, log, SCHEMA, KEY) == 0  # again: nothing twice


def test_only_folders_that_differ_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.replace_folders(frame(spark, {"a": (1.0, "x"), "b": (2.0, "y"), "c": (3.0, "z")}), path, ("part",))
    snapshots.replace_folders(frame(spark, {"b": (9.0, "y")}), path, ("part",))
    log = changelog.table_changes(spark, path, SCHEMA, KEY, 1)
    assert {f.split("part=")[1][0] for f in log.inputFiles()} == {"y"}
    assert [(r.op, r.k) for r in log.collect()] == [("update", "b")]


def test_a_log_over_an_expired_snapshot_stops(spark, tmp_path):
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    for v in range(3):
        snapshots.replace_folders(frame(spark, {"a": (float(v), "x")}), path, ("part",))
        if v == 0:
            changelog.append_changes(spark, path, log, SCHEMA, KEY)
    snapshots.expire(spark, path, keep=1)
    with pytest.raises(ValueError, match="expired"):
        changelog.append_changes(spark, path, log, SCHEMA, KEY)


def test_filters_on_steps_open_only_these(spark, tmp_path):
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    for v in range(3):
        snapshots.replace_folders(frame(spark, {"a": (float(v), "x")}), path, ("part",))
        changelog.append_changes(spark, path, log, SCHEMA, KEY)
    later = changelog.read_changes(spark, log, SCHEMA, KEY, after=2)
    assert "PartitionFilters: [isnotnull(snapshot" in later._jdf.queryExecution().executedPlan().toString()
    assert [(r.op, r.new.v) for r in later.collect()] == [("update", 2.0)]


def test_withdrawn_admissions_are_deletes(spark, tmp_path):
    landing, out, log = (str(tmp_path / n) for n in ("landing", "out", "log"))

    def run(*rows, competence="2024-03"):
        full = [(k, "410690", d, diagnosis, "10", "1") for k, d, diagnosis in rows]
        frame = spark.createDataFrame(full, "N_AIH string, MUNIC_RES string, DT_INTER string, DIAG_PRINC string, VAL_TOT string, DIAS_PERM string")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{landing}/state=PR/competence={competence}")
        jobs.ingest_admissions(spark, landing, out, jobs.AdmissionsRun((2024, 1), (2024, 12)))
        done = changelog.logged_until(spark, log)
        changed = jobs.log_admissions(spark, out, log)
        steps = jobs.read_admission_changes(spark, log, done).collect()
        assert len(steps) == changed
        return {(r.op, r.aih_number) for r in steps}

    assert run(("1", "20240305", "J189"), ("2", "20240306", "J189"), (None, "bad", "J189")) == {("insert", "1"), ("insert", "2"), ("insert", None)}
    assert run(("1", "20240405", "J189"), ("3", "20240306", "J189")) == {("update", "1"), ("delete", "2"), ("insert", "3"), ("delete", None)}
    assert run(("4", "20240406", "J189"), competence="2024-04") == {("insert", "4")}
    whole = clean_admissions(tables.read_landed_admissions(spark, landing), ("410690",), r"^J\d{2}")
    followed = changelog.replayed(jobs.read_admission_changes(spark, log), jobs.ADMISSION_KEY, schemas.ADMISSIONS.names)
    assert sorted(map(str, followed.drop("admission_month").collect())) == sorted(map(str, whole.collect()))
    assert followed.where(F.col("admission_month") == date(2024, 4, 1)).count() == 2
