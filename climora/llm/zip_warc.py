"""WARC records in ZIP packages: written in bounded archives, read by ranges without extraction.

A package holds ``archive/data.warc.gz`` (one gzip member per record, stored as it is) and
``indexes/index.cdx`` (offset, length and id of each record). A reader fetches the end of the file, the central
directory (of ZIP64 files too), the local headers of the two members, and the index; then any record is one range of
the file. Files are opened through Arrow's file systems (local, S3, GCS, HDFS).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climora.llm.storage import new_folder, parts_for, small_batches, stored

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Bytes of records after which a new package begins, and records that are read with one range.
PACKAGE_BYTES = 32 << 20
# Bytes of packages that one task reads records from.
BYTES_PER_TASK = 16 << 20
RANGE_RECORDS = 128
# Fixed values of the ZIP format: signatures, and the value that refers to the ZIP64 field.
_END, _END64, _LOCATOR64, _CENTRAL, _LOCAL = 0x06054B50, 0x06064B50, 0x07064B50, 0x02014B50, 0x04034B50
_IN_64 = 0xFFFFFFFF


class Member(NamedTuple):
    """A member of a package; ``start`` is the place of its local header."""

    name: str
    method: int
    packed: int
    size: int
    start: int


def _opened(uri: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _at(file, start: int, size: int) -> bytes:
    file.seek(start)
    data = file.read(size)
    if len(data) < size:
        raise ValueError("the package ends too early")
    return data


def directory(file, size: int) -> list[Member]:
    """The members of a package, from its central directory."""
    tail_size = min(size, 22 + 65535)
    tail = _at(file, size - tail_size, tail_size)
    at = tail.rfind(struct.pack("<I", _END))
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(struct.pack("<I", _END), 0, at)  # the signature inside a comment
    if at < 0:
        raise ValueError("no end of a central directory")
    count, length, begin = struct.unpack_from("<HII", tail, at + 10)
    if count == 0xFFFF or length == _IN_64 or begin == _IN_64:
        where = size - tail_size + at - 20
        mark, _, end64 = struct.unpack_from("<IIQ", _at(file, where, 20))
        if mark != _LOCATOR64:
            raise ValueError("no locator of the ZIP64 directory")
        mark, count, length, begin = struct.unpack("<I28xQQQ", _at(file, end64, 56))
        if mark != _END64:
            raise ValueError("no end of the ZIP64 directory")
    entries, out, at = _at(file, begin, length), [], 0
    for _ in range(count):
        mark, method, packed, full = struct.unpack_from("<I6xH8xII", entries, at)
        names, extras, comments, start = struct.unpack_from("<HHH8xI", entries, at + 28)
        if mark != _CENTRAL:
            raise ValueError("broken central directory")
        name = entries[at + 46 : at + 46 + names].decode("utf-8", "replace")
        values = [full, packed, start]
        extra, stop = at + 46 + names, at + 46 + names + extras
        while extra + 4 <= stop:
            kind, long = struct.unpack_from("<HH", entries, extra)
            if kind == 1:  # in this order, only the fields that refer here
                place = extra + 4
                for k in range(3):
                    if values[k] == _IN_64:
                        values[k] = struct.unpack_from("<Q", entries, place)[0]
                        place += 8
            extra += 4 + long
        out.append(Member(name, method, values[1], values[0], values[2]))
        at += 46 + names + extras + comments
    return out


def data_start(file, member: Member) -> int:
    """Where the bytes of a member begin."""
    mark, names, extras = struct.unpack("<I22xHH", _at(file, member.start, 30))
    if mark != _LOCAL:
        raise ValueError("no local header")
    return member.start + 30 + names + extras


def _content(file, member: Member) -> bytes:
    data = _at(file, data_start(file, member), member.packed)
    if member.method == 8:
        return zlib.decompress(data, -15)
    if member.method:
        raise ValueError(f"compression {member.method} of {member.name}")
    return data


def record_bytes(kind: str, record_id: str, uri: str, digest: str, length: int, payload: bytes | None, refers_to: str | None) -> bytes:
    """A WARC record with an HTTP block; ``payload`` is None for revisits."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload or b"")
    clean = "".join(c if c not in "\r\n" else " " for c in uri)
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {length}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parsed_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _id(page: int | None) -> str:
    return f"urn:climora:page:{'none' if page is None else page}"


def page_of(record_id: str | None) -> int | None:
    """The page that a record id of this module stands for."""
    last = (record_id or "").strip("<>").rpartition(":")[2]
    return None if last in ("", "none") else int(last)


def _packages(folder: str, package_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(folder)
        records: list[tuple[str, bytes]] = []

        def close() -> pa.RecordBatch:
            # the name is new for each attempt of a task; only those of the attempt that counts are listed
            name, index, at = f"{uuid.uuid4().hex}.zip", [], 0
            for record, data in records:
                index.append(f"{at} {len(data)} {record}")
                at += len(data)
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as package:
                package.writestr(DATA, b"".join(data for _, data in records))
                package.writestr(INDEX, "\n".join(index))
            system.create_dir(path, recursive=True)
            with system.open_output_stream(f"{path}/{name}", compression=None) as out:
                out.write(buffer.getvalue())
            made = (f"{folder}/{name}", buffer.tell(), len(records))
            records.clear()
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in made], ["path", "size", "records"])

        held = 0
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("id", "uri", "payload", "digest", "length", "response")]
            for id_, uri, payload, digest, length, response in zip(*columns):
                first = response == id_
                coded = base64.b32encode(bytes.fromhex(digest)).decode()
                raw = record_bytes(
                    "response" if first else "revisit", _id(id_), uri or "", coded, length, payload or b"" if first else None,
                    None if first else _id(response),
                )
                data = gzip.compress(raw, 4, mtime=0)
                records.append((_id(id_), data))
                held += len(data)
                if held >= package_bytes:
                    yield close()
                    held = 0
        if records:
            yield close()

    return write


def write_packages(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_bytes: int = 0, package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Writes a record per row below ``folder``; gives the stored list of packages (path, size, records).

    Of rows whose payloads are equal and have ``least_bytes`` at least, that with the largest id becomes a response and the others
    revisit it; rows that repeat that id are responses too. A null payload is empty, bytes that are no UTF-8 stay as they are (in urls they are replaced); a null id is smaller than any other and
    null urls are empty. An empty table writes nothing.
    """
    small_batches(pages.sparkSession)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    uri = F.make_valid_utf8(url_col).alias("uri")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), uri, F.col(payload_col).cast("binary").alias("payload")).withColumns(
        {"digest": F.sha1(payload), "length": F.octet_length(payload).cast("long")}
    ) if payload_col == "payload" else pages.select(
        F.col(id_col).cast("long").alias("id"), uri, F.col(payload_col).cast("binary").alias("payload"),
        F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("length"),
    )
    keys = stored(rows.select("id", "digest", "length"), "warc-digests")
    first = stored(keys.where(F.col("length") >= least_bytes).groupBy("digest").agg(F.max("id").alias("response")), "warc-responses")
    revisits = stored(
        keys.join(first, "digest").where(~F.col("id").eqNullSafe(F.col("response"))).select(
            F.col("id").alias("id_"), F.col("digest").alias("digest_"), "response"
        ).distinct(),
        "warc-revisits",
    )
    judged = rows.join(revisits, F.col("id").eqNullSafe(F.col("id_")) & (F.col("digest") == F.col("digest_")), "left").select(
        "id", "uri", F.when(F.col("digest_").isNull(), F.col("payload")).alias("payload"), "digest", "length",
        F.when(F.col("digest_").isNull(), F.col("id")).otherwise(F.col("response")).alias("response"),
    )
    return stored(judged.mapInArrow(_packages(folder, package_bytes), "path string, size long, records long"), "warc-packages")


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with _opened(path) as file:
                members = {m.name: m for m in directory(file, file.size())}
                data, index = members[DATA], _content(file, members[INDEX]).decode()
                if data.method:
                    raise ValueError("records have to be stored for reading by ranges")
                begin = data_start(file, data)
            spots = [tuple(map(int, line.split(" ", 2)[:2])) for line in index.split("\n") if line]
            for at in range(0, len(spots), RANGE_RECORDS):
                some = spots[at : at + RANGE_RECORDS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([[begin + a for a, _ in some]]), pa.array([[n for _, n in some]])], ["path", "at", "length"]
                )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, at, length in zip(*(batch.column(n).to_pylist() for n in ("path", "at", "length"))):
            rows = []
            with _opened(path) as file:
                data = _at(file, at[0], at[-1] + length[-1] - at[0])
            for begin, size in zip(at, length):
                fields, payload = parsed_record(gzip.decompress(data[begin - at[0] : begin - at[0] + size]))
                kind, stated = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response":
                    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if found != stated:
                        raise ValueError(f"the payload of {fields['warc-record-id']} does not match its digest")
                refers = fields.get("warc-refers-to")
                rows.append((
                    path, begin, kind, fields["warc-record-id"].strip("<>"), fields.get("warc-target-uri"), stated,
                    len(payload) if kind == "response" else int(fields["warc-payload-length"]),
                    refers.strip("<>") if refers else None, payload if kind == "response" else None,
                ))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*rows), _KINDS)], _NAMES
            )


_NAMES = ["path", "place", "kind", "record_id", "uri", "digest", "length", "refers_to", "payload"]
_KINDS = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]


def read_packages(packages: DataFrame) -> DataFrame:
    """One row per record of the packages listed in column path: place, kind, ids, digest, length and payload.

    A task reads the directories and index of a package; its records are then read by ranges, spread over all tasks.
    Revisits have no payload; ``length`` is that of the payload they stand for.
    """
    spread = packages.select("path").repartition("path")
    ranges = spread.mapInArrow(_ranges, "path string, at array<long>, length array<long>")
    place = (F.col("path"), F.col("at")[0])
    # The ranges are tiny, what they stand for is not: tasks by the bytes of the packages, where these are known.
    size = packages.agg(F.sum("size")).first()[0] if "size" in packages.columns else None
    dealt = ranges.repartition(*place) if size is None else ranges.repartition(parts_for(size, BYTES_PER_TASK), *place)
    return dealt.mapInArrow(
        _read,
        "path string, place long, kind string, record_id string, uri string, digest string, length long, refers_to string, payload binary",
    )


def page_column(record_col: str):
    """The page id of a record id."""
    last = F.substring_index(record_col, ":", -1)
    return F.when(last != "none", last).cast("long")


def packed_and_read(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The records of ``pages`` (page_id, url, html), read back from packages in the shared folder."""
    return read_packages(write_packages(pages, new_folder(pages.sparkSession, "warc"), least_bytes=least_bytes))
