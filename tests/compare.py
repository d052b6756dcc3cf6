"""Side-by-side run of the registered queries and their SQL."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        return value.date().isoformat()
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def difference(frame, con, text: str) -> tuple[int, str]:
    """Row count of the Spark side, and what differs ('' when nothing does)."""
    have = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(text)
    want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if have[0] != want[0]:
        return len(have[1]), f"columns {have[0]} against {want[0]}"
    if len(have[1]) != len(want[1]):
        return len(have[1]), f"{len(have[1])} rows against {len(want[1])}"
    off = [(a, b) for a, b in zip(have[1], want[1]) if a != b]
    if off:
        return len(have[1]), f"{len(off)} rows differ, first {off[0]}"
    return len(have[1]), ""
