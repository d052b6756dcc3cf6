import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climora import schemas
from climora.operators import changes
from climora.sources import layout, sinks, snapshots, tables

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("day", T.DateType()), T.StructField("part", T.StringType())])


def files(spark, path):
    return {f: len(s) for f, s in snapshots.files_of(spark, path, snapshots.snapshot(spark, path)).items()}


def many_files(spark, path, n=400, parts=("x", "a/b c", None), spread=6):
    rows = [(i, date(2024, 1, 1 + i % 28), parts[i % len(parts)]) for i in range(n)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(spread)
    held = snapshots.commit(spark, path, ("part",), snapshots.write_beside(frame, path, ("part",), dealt=True))
    return held, rows


def content(spark, path):
    return sorted((tuple(r) for r in snapshots.read_published(spark, path, SCHEMA).collect()), key=lambda r: r[0])


@pytest.mark.parametrize("seed", range(5))
def test_bins_hold_what_fits(seed):
    rng = random.Random(seed)
    sizes = {f"f{i}": rng.randrange(1, 150) for i in range(60)}
    bins = layout.pack_files(sizes, 100)
    used = {}
    for name, spot in bins.items():
        used.setdefault(spot, []).append(sizes[name])
    assert sorted(used) == list(range(len(used))) and set(bins) == set(sizes)
    assert all(sum(u) <= 100 or len(u) == 1 for u in used.values())
    assert sum(sum(u) <= 50 for u in used.values()) <= 1  # two half-empty bins would be one
    assert layout.pack_files({}, 100) == {}


def test_compaction_keeps_rows_and_leaves_a_file_per_bin(spark, tmp_path):
    path = str(tmp_path / "t")
    _, rows = many_files(spark, path)
    snapshots.replace_folders(spark.createDataFrame([(9999, date(2024, 2, 1), "single")], SCHEMA).coalesce(1), path, ("part",))
    before = files(spark, path)
    assert sum(before.values()) > 12 and before["part=single"] == 1
    single = snapshots.snapshot(spark, path).folders["part=single"]
    assert layout.compact(spark, path, SCHEMA) == sum(before.values()) - 4
    assert set(files(spark, path).values()) == {1} and len(files(spark, path)) == 4
    assert snapshots.snapshot(spark, path).folders["part=single"] == single  # nothing to pack: not rewritten
    assert content(spark, path) == sorted([*rows, (9999, date(2024, 2, 1), "single")], key=lambda r: r[0])
    assert layout.compact(spark, path, SCHEMA) == 0
    assert snapshots.snapshot_numbers(spark, path) == [1, 2, 3]


def test_bins_of_a_target_size(spark, tmp_path):
    path = str(tmp_path / "t")
    many_files(spark, path, parts=("x",), spread=8)
    sizes = snapshots.files_of(spark, path, snapshots.snapshot(spark, path))["part=x"]
    layout.compact(spark, path, SCHEMA, target_bytes=3 * max(sizes.values()))
    assert files(spark, path) == {"part=x": 3}
    assert layout.compact(spark, str(tmp_path / "nothing"), SCHEMA) == 0


def test_compaction_gives_way_to_a_writer(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    many_files(spark, path, parts=("x", "y"))
    made = snapshots.write_beside

    def slow(*args, **kwargs):
        written = made(*args, **kwargs)
        monkeypatch.setattr(snapshots, "write_beside", made)
        snapshots.replace_folders(spark.createDataFrame([(1, None, "x")], SCHEMA), path, ("part",))
        return written

    monkeypatch.setattr(snapshots, "write_beside", slow)
    with pytest.raises(snapshots.ConcurrentChange):
        layout.compact(spark, path, SCHEMA)
    assert [r for r in content(spark, path) if r[2] == "x"] == [(1, None, "x")]


def test_compacted_admissions_keep_their_indexes(spark, tmp_path):
    path = str(tmp_path / "a")
    fields = T.StructType([f for f in schemas.VERSIONED_ADMISSIONS if f.name != "admission_month"])
    rows = [(f"41{n:09}", "410690", date(2024, 1 + n % 2, 5), "J189", 1.0, 1.0, "2024-01", "PR") for n in range(60)]
    frame = sinks.with_admission_month(spark.createDataFrame(rows, fields)).select(*schemas.VERSIONED_ADMISSIONS.names).repartition(5)
    written = snapshots.write_beside(frame, path, ("admission_month",), sinks.ADMISSION_SIDES, dealt=True)
    snapshots.commit(spark, path, ("admission_month",), written)
    assert layout.compact(spark, path, schemas.VERSIONED_ADMISSIONS, sides=sinks.ADMISSION_SIDES) == 8
    held = snapshots.snapshot(spark, path)
    key = spark.createDataFrame([("41000000003",)], "aih_number string")
    assert set(changes.folders_to_open(spark, path, held, key).folders) == {"admission_month=2024-02-01"}
    assert tables.read_admissions(spark, path).count() == 60


def climate(spark, *rows):
    full = [(s, d, "N", st, None, None, t, None, None, None, None) for s, d, st, t in rows]
    return spark.createDataFrame(full, schemas.DAILY_CLIMATE)


def shown(frame):
    return sorted((r.station_code, r.date, r.state, r.avg_temp) for r in frame.collect())


def test_move_to_state_and_month_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "days"), str(tmp_path / "states")
    days = [date(2023, 12, 28) + timedelta(days=9 * n) for n in range(8)]
    rows = [(s, d, st, float(d.day)) for d in days for s, st in (("A", "PR"), ("B", "SC"))]
    sinks.write_daily_climate(climate(spark, *rows), source)
    made, calls = snapshots.replace_folders, []

    def stops(*args, **kwargs):
        if len(calls) == 2:
            raise OSError("stopped")
        calls.append(kwargs["label"])
        return made(*args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr(snapshots, "replace_folders", stops)
        with pytest.raises(OSError):
            layout.migrate_climate(spark, source, target)
    assert calls == ["2023-12", "2024-01"]
    assert shown(tables.read_daily_climate(spark, target)) == sorted(r for r in rows if r[1] < date(2024, 2, 1))
    assert layout.migrate_climate(spark, source, target) == ["2024-02"]
    assert layout.migrate_climate(spark, source, target) == []
    assert shown(tables.read_daily_climate(spark, target)) == sorted(rows) == shown(tables.read_daily_climate(spark, source))
    assert len(files(spark, target)) == 6 and set(files(spark, target).values()) == {1}
    plan = tables.read_daily_climate(spark, target, date(2024, 2, 1)).where("state = 'PR'")
    filters = plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "state#" in filters and "year#" in filters
    with pytest.raises(ValueError):
        layout.migrate_climate(spark, source, target, sinks.CLIMATE_BY_DATE)


def test_merge_into_a_published_table(spark, tmp_path):
    source, target = str(tmp_path / "days"), str(tmp_path / "states")
    rows = [("A", date(2024, 1, 5), "PR", 1.0), ("B", date(2024, 1, 5), "PR", 2.0), ("C", date(2024, 1, 5), "S/P", 3.0), ("A", date(2024, 2, 5), "PR", 4.0)]
    sinks.write_daily_climate(climate(spark, *rows), source)
    layout.migrate_climate(spark, source, target)
    before = snapshots.snapshot(spark, target)
    # B moves to another state, C too and leaves its folder empty, D is new.
    fresh = [("B", date(2024, 1, 5), "SC", 7.0), ("C", date(2024, 1, 5), None, 8.0), ("D", date(2024, 1, 6), "SC", 9.0)]
    for _ in range(2):
        assert changes.merge_daily_climate(spark, climate(spark, *fresh), target) == 3
        want = [rows[0], rows[3], *fresh]
        assert sorted(shown(tables.read_daily_climate(spark, target)), key=str) == sorted(want, key=str)
    after = snapshots.snapshot(spark, target)
    assert "state=PR/year=2024/month=2" in after.folders and after.folders["state=PR/year=2024/month=2"] == before.folders["state=PR/year=2024/month=2"]
    assert not any(f.startswith("state=S%2FP") for f in after.folders)


def test_folder_names_are_those_of_spark(spark, tmp_path):
    values = ["a b", "x/y", "50%", "ä=ö", "q?", "[z]", "", None, "c:d"]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    frame.write.partitionBy("v").parquet(str(tmp_path / "t"))
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {sinks.folder_name("v", v) for v in values}
    assert {snapshots.folder_values(sinks.folder_name("v", v))[0] for v in values} == {v or None for v in values}
