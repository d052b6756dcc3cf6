import io
import zipfile
from datetime import date

import pytest

from climora.operators.climate import aggregate_daily, normalize_readings
from climora.params import ClimateRun
from climora.plans import jobs
from climora.sources import archive_members as A
from climora.sources import tables
from climora.sources.archives import hourly_records, pack_archive, scan_archives
from test_archives import ROW, member, station_file

CODES = [f"Z{n:03}" for n in range(40, 60)]


def rows(frame):
    return sorted((r.archive_year, r.station_code, r.member, bytes(r.content)) for r in frame.collect())


@pytest.fixture
def landing(tmp_path):
    tmp_path.joinpath("zips").mkdir()
    for year in (2018, 2020):
        files = [(member(c, year=year), station_file([(f"{year}/09/0{d}", *ROW) for d in (1, 2)] * (1 + n), c)) for n, c in enumerate(CODES)]
        (tmp_path / "zips" / f"{year}.zip").write_bytes(pack_archive([("README.txt", b"no station"), *files, (member(CODES[0], "AGAIN", year), b"later")]))
    return str(tmp_path / "zips")


@pytest.mark.parametrize("stations", [None, ("Z041",), ("Z055", "Z041", "Z999"), ("Z999",)])
@pytest.mark.parametrize("split", [1, 700, 1 << 20])
def test_same_as_the_scan_of_whole_archives(spark, landing, stations, split):
    span = date(2017, 5, 1), date(2021, 2, 1)
    got = A.scan_archive_members(spark, landing, *span, stations, split)
    assert rows(got) == rows(scan_archives(spark, landing, *span, stations))
    assert got.columns == ["archive_year", "station_code", "member", "content"]


def test_partitions_follow_the_bytes_that_are_wanted(spark, landing):
    span = date(2018, 1, 1), date(2020, 12, 31)
    assert A.scan_archive_members(spark, landing, *span, None, 1).rdd.getNumPartitions() == 2 * len(CODES)
    assert A.scan_archive_members(spark, landing, *span, ("Z041", "Z055"), 1).rdd.getNumPartitions() == 4
    assert A.scan_archive_members(spark, landing, *span).rdd.getNumPartitions() == 2
    few = A.scan_archive_members(spark, landing, *span, None, 2000).rdd.getNumPartitions()
    assert 2 < few < 2 * len(CODES)
    assert A.scan_archive_members(spark, landing, date(2030, 1, 1), date(2031, 1, 1)).collect() == []
    assert A.scan_archive_members(spark, f"file://{landing}", *span, ("Z041",)).count() == 2


def test_only_the_bytes_of_wanted_members_are_read(landing):
    class Counted:
        def __init__(self, file):
            self.file, self.read_bytes = file, 0

        def seek(self, *args):
            return self.file.seek(*args)

        def read(self, n):
            self.read_bytes += n
            return self.file.read(n)

    store, path = A.open_store(f"{landing}/2018.zip")
    (wanted,) = A.list_members(store, path, ("Z045",))
    with store.open_input_file(path) as file:
        counted = Counted(file)
        assert A.read_member(counted, wanted) == station_file([(f"2018/09/0{d}", *ROW) for d in (1, 2)] * 6, "Z045")
    assert counted.read_bytes == wanted.compressed + 30


class Unseekable(io.RawIOBase):
    """A stream that an archive can only be appended to: sizes then stand behind the data, not before them."""

    def __init__(self):
        self.held = io.BytesIO()

    def writable(self):
        return True

    def write(self, data):
        return self.held.write(bytes(data))


def test_archives_of_other_makes(spark, tmp_path):
    text = station_file([("2019/09/01", *ROW)])
    stream = Unseekable()
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(member(), text)
    (tmp_path / "2019.zip").write_bytes(b"something before the archive" + stream.held.getvalue())
    with zipfile.ZipFile(tmp_path / "2020.zip", "w", zipfile.ZIP_STORED) as archive:
        archive.comment = b"a comment"
        with archive.open(member(year=2020), "w", force_zip64=True) as out:
            out.write(text)
        archive.writestr(member("Z043", year=2020), b"")
    got = rows(A.scan_archive_members(spark, str(tmp_path), date(2019, 1, 1), date(2020, 1, 1)))
    assert [(y, s, c) for y, s, _, c in got] == [(2019, "Z042", text), (2020, "Z042", text), (2020, "Z043", b"")]


def test_damaged_archives_stop_the_scan(spark, tmp_path):
    data = bytearray(pack_archive([(member(), station_file([("2019/09/01", *ROW)] * 50))]))
    data[200] ^= 255
    (tmp_path / "2019.zip").write_bytes(bytes(data))
    with pytest.raises(Exception, match="invalid|does not agree"):
        A.scan_archive_members(spark, str(tmp_path), date(2019, 1, 1), date(2019, 1, 1)).collect()
    other = io.BytesIO()
    with zipfile.ZipFile(other, "w", zipfile.ZIP_BZIP2) as archive:
        archive.writestr(member(), b"x")
    (tmp_path / "2019.zip").write_bytes(other.getvalue())
    with pytest.raises(Exception, match="method 12"):
        A.scan_archive_members(spark, str(tmp_path), date(2019, 1, 1), date(2019, 1, 1)).collect()
    with pytest.raises(ValueError):
        A.scan_archive_members(spark, str(tmp_path), date(2019, 1, 1), date(2019, 1, 1), ("a,b",))


def test_job_reads_members(spark, landing, tmp_path):
    run = ClimateRun(date(2018, 9, 2), date(2020, 9, 1), ("Z041", "Z042"))
    assert jobs.ingest_climate(spark, landing, str(tmp_path / "out"), run) == 4
    days = {(r.station_code, r.date) for r in tables.read_daily_climate(spark, str(tmp_path / "out")).collect()}
    assert days == {(s, d) for s in run.stations for d in (date(2018, 9, 2), date(2020, 9, 1))}
    span = run.start, run.end
    other = aggregate_daily(normalize_readings(hourly_records(scan_archives(spark, landing, *span, run.stations), *span)))
    assert other.exceptAll(tables.read_daily_climate(spark, str(tmp_path / "out")).select(*other.columns)).count() == 0
