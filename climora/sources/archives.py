"""Hourly station files: yearly ZIP archives, or the same files unpacked.

Both readers give one row per station file (``archive_year, station_code, member, content``), at
most one file per station and year. A station file holds one station-year (about 9,000 lines), so
a row stays near 1 MB however many files there are. Everything after the unzip is column work.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from datetime import date

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from climora.functions.parsing import blank_to_null, csv_cells, slash_date

# Layout of a station file.
ENCODING = "ISO-8859-1"
METADATA_LINES = 8
METADATA_KEYS = {
    "DC_NOME": "ESTACAO:",
    "UF": "UF:",
    "VL_LATITUDE": "LATITUDE:",
    "VL_LONGITUDE": "LONGITUDE:",
}
DATE_HEADER = "Data"
MEASURE_HEADERS = {
    "TEM_INS": "TEMPERATURA DO AR - BULBO SECO, HORARIA (°C)",
    "TEM_MAX": "TEMPERATURA MÁXIMA NA HORA ANT. (AUT) (°C)",
    "TEM_MIN": "TEMPERATURA MÍNIMA NA HORA ANT. (AUT) (°C)",
    "UMD_INS": "UMIDADE RELATIVA DO AR, HORARIA (%)",
    "CHUVA": "PRECIPITAÇÃO TOTAL, HORÁRIO (mm)",
}

# Every line boundary that can occur in Latin-1 text, besides the line feed itself.
_OTHER_LINE_ENDS = ("\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85")

# The station code is the fourth underscore-separated part of a member name.
_STATION_PART = re.compile(r"^[^_]*_[^_]*_[^_]*_([^_]+)_")

MEMBER_FIELDS = pa.schema(
    [
        ("archive_year", pa.int32()),
        ("station_code", pa.string()),
        ("member", pa.string()),
        ("content", pa.binary()),
    ]
)
MEMBER_SCHEMA = "archive_year int, station_code string, member string, content binary"


def years_of(start: date, end: date) -> range:
    return range(start.year, end.year + 1)


def first_members(
    names: Iterable[str], stations: tuple[str, ...] | None
) -> dict[str, str]:
    """Station code to the first member that carries it, in archive order.

    With a station list a member belongs to a code when ``_code_`` occurs in its name; without one
    the code is read from the naming pattern.
    """
    chosen: dict[str, str] = {}
    for name in names:
        if stations is None:
            part = _STATION_PART.match(name.rsplit("/", 1)[-1])
            codes = [part.group(1)] if part else []
        else:
            codes = [code for code in stations if f"_{code}_" in name]
        for code in codes:
            chosen.setdefault(code, name)
    return chosen


def unpack(archives: DataFrame, stations: tuple[str, ...] | None = None) -> DataFrame:
    """Station files of yearly ZIPs given as rows ``archive_year int, content binary``."""

    def open_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for year, blob in zip(batch.column(0), batch.column(1)):
                with zipfile.ZipFile(pa.BufferReader(blob.as_buffer())) as archive:
                    for code, name in first_members(archive.namelist(), stations).items():
                        cells = [[year.as_py()], [code], [name], [archive.read(name)]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(cells, MEMBER_FIELDS)],
                            schema=MEMBER_FIELDS,
                        )

    return archives.select("archive_year", "content").mapInArrow(open_each, MEMBER_SCHEMA)


def scan_archives(
    spark: SparkSession,
    root: str,
    start: date,
    end: date,
    stations: tuple[str, ...] | None = None,
) -> DataFrame:
    """Station files of the archives ``root/<year>.zip`` for the years of the range.

    A year without an archive contributes nothing. A ZIP cannot be split, so its members are
    spread over the cluster right after the unzip, before the costly text work.
    """
    wanted = ",".join(f"{year}.zip" for year in years_of(start, end))
    archives = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"{{{wanted}}}")
        .load(root)
        .select(
            F.regexp_extract("path", r"(\d{4})\.zip$", 1).cast("int").alias("archive_year"),
            "content",
        )
    )
    return unpack(archives, stations).repartition("archive_year", "station_code")


def scan_station_files(
    spark: SparkSession,
    root: str,
    start: date,
    end: date,
    stations: tuple[str, ...] | None = None,
) -> DataFrame:
    """Station files already unpacked under ``root/<year>/``; first name per station wins.

    Only the folders of the wanted years are listed; a year without a folder contributes nothing.
    The winners are found from paths alone; Spark sends them to every task while they are small, and
    joins by shuffle beyond that.
    """
    wanted = ",".join(str(year) for year in years_of(start, end))
    try:
        files = spark.read.format("binaryFile").load(f"{root}/{{{wanted}}}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MEMBER_SCHEMA)
    year = F.regexp_extract("path", r"/(\d{4})/[^/]*$", 1).cast("int")
    name = F.element_at(F.split("path", "/"), -1)
    named = files.select("path", year.alias("archive_year"), name.alias("member"), "content")
    if stations is None:
        code = F.nullif(F.regexp_extract("member", _STATION_PART.pattern, 1), F.lit(""))
        coded = named.withColumn("station_code", code)
    else:
        hits = [F.when(F.contains("member", F.lit(f"_{s}_")), F.lit(s)) for s in stations]
        coded = named.withColumn("station_code", F.explode(F.array_compact(F.array(*hits))))
    coded = coded.filter(F.col("station_code").isNotNull())
    first = coded.groupBy("archive_year", "station_code").agg(F.min("path").alias("path"))
    return coded.join(first, ["archive_year", "station_code", "path"], "left_semi").select(
        "archive_year", "station_code", "member", "content"
    )


def _lines(content: Column) -> Column:
    """Lines of a file. Plain replacements and a one-character split need no regular expression."""
    text = F.decode(content, ENCODING)
    for end in _OTHER_LINE_ENDS:
        text = F.replace(text, F.lit(end), F.lit("\n"))
    return F.split(text, "\n")


def _metadata_value(head: Column, key: str) -> Column:
    """Value of the last ``key;value`` line among the metadata lines."""
    lines = F.filter(head, lambda line: F.startswith(line, F.lit(key + ";")))
    return blank_to_null(F.substr(F.get(lines, F.size(lines) - 1), F.lit(len(key) + 2)))


def _places(header: Column) -> Column:
    """0-based place of the date and of each measure, NULL when absent; of equal titles the last."""

    def place(title: Column) -> Column:
        from_end = F.array_position(F.reverse(header), title)
        return F.when(from_end > 0, (F.size(header) - from_end).cast("int"))

    titles = F.array(*[F.lit(t) for t in (DATE_HEADER, *MEASURE_HEADERS.values())])
    return F.transform(titles, place)


def station_layout(members: DataFrame) -> DataFrame:
    """Per station file: its metadata, the place of each column, and its data lines as an array."""
    lines = members.select(
        "archive_year",
        "station_code",
        _lines(F.col("content")).alias("lines"),
    ).select(
        "archive_year",
        "station_code",
        "lines",
        F.slice("lines", 1, METADATA_LINES).alias("head"),
        F.transform(
            F.split(F.get("lines", F.lit(METADATA_LINES)), ";"), lambda title: F.trim(title)
        ).alias("header"),
    )
    return lines.select(
        "archive_year",
        "station_code",
        *[_metadata_value(F.col("head"), key).alias(f) for f, key in METADATA_KEYS.items()],
        _places(F.col("header")).alias("places"),
        F.slice("lines", METADATA_LINES + 2, F.greatest(F.size("lines"), F.lit(1))).alias("body"),
    )


def hourly_records(members: DataFrame, start: date, end: date) -> DataFrame:
    """Hourly records inside the inclusive date range, measures still text.

    Besides the source fields each row carries ``read_order``: years in order, then lines in file
    order. Lines with no usable date are left out.

    Two details keep each text from being taken apart more than once. The lines are exploded with
    ``outer``, as Spark otherwise tests every body for emptiness on its own. The cells pass through
    a one-element ``inline``, as the date filter would otherwise be pushed below the split and
    repeat it.
    """
    layout = station_layout(members)
    constants = [c for c in layout.columns if c != "body"]
    rows = layout.select(*constants, F.posexplode_outer("body").alias("line_no", "line"))
    cells = rows.select(*constants, "line_no", csv_cells(F.col("line")).alias("line_cells"))
    dated = cells.select(
        *constants,
        "line_no",
        F.inline(
            F.array(
                F.struct(
                    slash_date(F.get("line_cells", F.get("places", F.lit(0)))).alias("DT_MEDICAO"),
                    F.col("line_cells").alias("cells"),
                )
            )
        ),
    )
    return dated.filter(F.col("DT_MEDICAO").between(start, end)).select(
        F.col("station_code").alias("CD_ESTACAO"),
        *METADATA_KEYS,
        "DT_MEDICAO",
        *[
            F.get("cells", F.get("places", F.lit(i))).alias(name)
            for i, name in enumerate(MEASURE_HEADERS, start=1)
        ],
        (F.shiftleft(F.col("archive_year").cast("long"), 32) + F.col("line_no")).alias("read_order"),
    )


def pack_archive(members: Iterable[tuple[str, bytes]]) -> bytes:
    """A ZIP with the given (name, content) members, for fixtures and hand-made landings."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members:
            archive.writestr(name, content)
    return buffer.getvalue()
