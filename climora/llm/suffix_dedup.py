"""Exact removal of byte strings that occur earlier, by distributed suffix sorting.

A string of ``length`` bytes is found through one suffix that starts inside it: that whose first
40 bytes hash lowest among all in the string (the leftmost on ties). The choice rests on the
string alone, so equal strings choose equal suffixes, and a thirtieth of all suffixes is enough to sort.
Sampled splitters range-partition the suffixes by their leading bytes; each bucket sorts its own by
multikey quicksort over words of eight bytes, and what touches a bucket's edges is compared across the
boundaries by an aggregate of its first occurrences.

The sort is run twice. First on records: a chosen suffix with all strings that choose it. Records of
equal content after the first are repeats as a whole. First records whose suffix has other contents
as well are then sorted string by string. Contents are compared by fingerprints: 32 bits of the leading
bytes with 80 bits of two hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from climora.llm.storage import small_batches, stored, tidied

LENGTH = 100
LEAD = 40
#: Rows that a bucket holds on average, and rows of the sample that splitters are taken from.
BUCKET_ROWS = 400_000
SAMPLE_ROWS = 50_000
# Texts that splitters are drawn from at least.
SAMPLED_TEXTS = 200
_PIECE = 1 << 16
_HELD = 1 << 20  # strings that a task deals out at once
_FACTOR = 0x9E3779B97F4A7C15
_NO_ID = -(2**63)
_CONTENT = np.uint64((1 << 48) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, _FACTOR, np.uint64)
    up[0] = 1
    down = np.full(n + 1, pow(_FACTOR, -1, 1 << 64), np.uint64)
    down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class _Hashes:
    """Hashes of any stretch of a buffer, from running sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1])))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def _leading(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    word = np.zeros(len(at), np.uint64)
    for k in range(4):
        word = word << np.uint64(8) | data[at + k].astype(np.uint64)
    return word << np.uint64(32)


def _lowest(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each start, the place of the lowest of ``width`` hashes, the leftmost on ties."""
    best, have = np.arange(len(hashes)), 1
    while have < width:
        step = min(have, width - have)
        left, right = best[:-step], best[step:]
        best = np.where(hashes[right] < hashes[left], right, left)
        have += step
    return best


def chosen_suffixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH):
    """Records of the documents at ``starts``..``ends`` of a buffer.

    Arrays: key (leading bytes and hash), content hash, number of the document, and the first string's
    start, the count of strings less one, and the suffix's distance from the first start, packed.
    """
    out = []
    width = length - LEAD + 1
    long = np.nonzero(ends - starts >= length)[0]
    if not len(long):
        return [np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    lead_of = starts[long]
    first, last = int(lead_of[0]), int(ends[long[-1]])
    for at in range(first, last - length + 1, _PIECE):
        stop = min(at + _PIECE + length - 1, last)  # strings start in at .. stop - length
        piece = data[at:stop]
        hashes = _Hashes(piece)
        grams = np.arange(len(piece) - LEAD + 1)
        gram = hashes.of(grams, grams + LEAD)
        lowest = _lowest(gram, width)
        start = np.arange(len(lowest))
        doc = long[np.maximum(np.searchsorted(lead_of, start + at, "right") - 1, 0)]
        valid = (start + at >= starts[doc]) & (start + at + length <= ends[doc])
        fresh = valid.copy()
        fresh[1:] &= ~valid[:-1] | (lowest[1:] != lowest[:-1]) | (doc[1:] != doc[:-1])
        begin = np.nonzero(fresh)[0]
        if not len(begin):
            continue
        group = np.cumsum(fresh) - 1
        count = np.bincount(group[valid], minlength=len(begin))
        low, suffix, of = begin, lowest[begin], doc[begin]
        key = _leading(piece, suffix) | gram[suffix] >> np.uint64(32)
        content = (hashes.of(low, low + count - 1 + length) + _mixed((suffix - low).astype(np.uint64))) & _CONTENT
        packed = (low + at - starts[of]) << 14 | (count - 1) << 7 | (suffix - low)
        out.append([key, content, of, packed])
    if not out:
        return [np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    return [np.concatenate(x) for x in zip(*out)]


def single_strings(data: np.ndarray, packed: np.ndarray, length: int = LENGTH):
    """One record for each string of the packed records of one document."""
    low, more = packed >> 14, packed >> 7 & 127
    at = np.repeat(low, more + 1) + np.arange(int((more + 1).sum())) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
    out = []
    for begin in range(0, len(at), _PIECE):
        some = at[begin : begin + _PIECE]
        first = int(some.min())
        piece = data[first : int(some.max()) + length]
        start = some - first
        whole = _Hashes(piece).of(start, start + length)
        half = _Hashes(piece ^ 0x5A).of(start, start + length)
        out.append([_leading(piece, start) | whole >> np.uint64(32), _mixed(half ^ whole << np.uint64(32)) & _CONTENT, some << 14])
    return [np.concatenate(x) for x in zip(*out)]


def _joined(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [t or b"" for t in texts]
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], ends[:-1])).astype(np.int64), ends


def _slices(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``most`` bytes, one row at least."""
    for batch in batches:
        each = max(1, batch.nbytes // max(1, batch.num_rows))
        rows = max(1, most // each)
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


_RECORD = "key long, content long, id long, packed long"


def _records(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[list[np.ndarray]]:
    for part in _slices(batches):
        ids = part.column("id").to_numpy(zero_copy_only=False)
        key, content, doc, packed = chosen_suffixes(*_joined(part.column("text").to_pylist()), length)
        yield [key, content, ids[doc], packed]


def _strings(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for part in _slices(batches):
        for id_, text, packed in zip(*(part.column(c).to_pylist() for c in ("id", "text", "packed"))):
            data = np.frombuffer(text or b"", np.uint8)
            here = np.unique(np.array(packed, np.int64))
            here = here[(here >> 14) + (here >> 7 & 127) + length <= len(data)]
            if len(here):
                key, content, at = single_strings(data, here, length)
                held.append([key, content, np.full(len(at), id_, np.int64), at])
                size += len(at)
            if size >= _HELD:
                yield [np.concatenate(x) for x in zip(*held)]
                held, size = [], 0
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _splitters(sample: list, buckets: int) -> list[np.ndarray]:
    """Records that part the sample evenly; the key of a hot group is met several times."""
    if not sample or buckets < 2:
        return [np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    key, content, id_, packed = (np.array(x, np.int64) for x in zip(*sample))
    key, content = key.view(np.uint64), content.view(np.uint64)
    order = np.lexsort((packed, id_, content, key))
    order = order[np.unique(np.arange(1, buckets) * len(order) // buckets)]
    return [x[order] for x in (key, content, id_, packed)]


def bucket_of(splitters: list[np.ndarray], rows: list[np.ndarray]) -> np.ndarray:
    """How many splitters are no greater than each record, in the order of (key, content, id, packed)."""
    first = np.searchsorted(splitters[0], rows[0], "left")
    after = np.searchsorted(splitters[0], rows[0], "right")
    bucket = first.copy()
    tied = np.nonzero(after > first)[0]  # keys that are splitters themselves
    while len(tied):
        at, value = bucket[tied], tied
        passed = np.zeros(len(tied), bool)
        open_ = np.ones(len(tied), bool)
        for s, r in zip(splitters[1:], rows[1:]):
            passed |= open_ & (r[value] > s[at])
            open_ &= r[value] == s[at]
        passed |= open_
        bucket[tied[passed]] += 1
        tied = tied[passed]
        tied = tied[bucket[tied] < after[tied]]
    return bucket


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Multikey quicksort: order by the first word, then only tied stretches by the next."""
    order = np.argsort(columns[0], kind="stable")
    tied = np.zeros(len(order), bool)
    for k, column in enumerate(columns[1:]):
        ranked = columns[k][order]
        same = ranked[1:] == ranked[:-1]
        if k:
            same &= tied[1:]
        tied = np.concatenate(([False], same))
        inside = np.nonzero(tied | np.concatenate((same, [False])))[0]
        if not len(inside):
            break
        stretch = np.cumsum(~tied)[inside]
        order[inside] = order[inside][np.lexsort((column[order[inside]], stretch))]
    return order


def _planes(words: np.ndarray) -> bytes:
    """Words of eight bytes, all first bytes before all second ones and so on: shuffles compress them better."""
    return np.ascontiguousarray(words.view(np.uint8).reshape(-1, 8).T).tobytes()


def _words(block: bytes) -> np.ndarray:
    """The four columns of a block."""
    planes = np.frombuffer(block, np.uint8).reshape(4, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint64)[:, :, 0]


def _dealt(make: Callable, splitters: list[np.ndarray], length: int):
    """Records of a task as one block of bytes for each bucket."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in make(batches, length):
            if not len(rows[0]):
                continue
            bucket = bucket_of(splitters, rows)
            order = np.lexsort((rows[0], bucket))
            buckets, begin = np.unique(bucket[order], return_index=True)
            blocks = [b"".join(_planes(x[part]) for x in rows) for part in np.split(order, begin[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets.astype(np.int32)), pa.array(blocks, pa.binary())], ["bucket", "block"]
            )

    return deal


_JUDGED = "repeat boolean, edge boolean, key long, content long, id long, packed long"


def _judged(length: int):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sort each bucket of a task; give repeats, and first records that have to be looked at again."""
        blocks: dict[int, list[list[np.ndarray]]] = {}
        for batch in batches:
            for bucket, block in zip(batch.column("bucket").to_pylist(), batch.column("block").to_pylist()):
                words = _words(block)
                blocks.setdefault(bucket, []).append([words[0], words[1], words[2].view(np.int64), words[3].view(np.int64)])
        for bucket in sorted(blocks):
            rows = [np.concatenate(x) for x in zip(*blocks.pop(bucket))]
            order = multikey_order(rows)
            key, content, id_, packed = (x[order] for x in rows)
            new_key = np.concatenate(([True], key[1:] != key[:-1]))
            new = new_key | np.concatenate(([True], content[1:] != content[:-1]))
            first = np.nonzero(new)[0][np.cumsum(new) - 1]
            low = packed >> 14
            repeat = (id_ != id_[first]) | (low != low[first])
            edge = (key == key[0]) | (key == key[-1])
            contents = np.bincount(np.cumsum(new_key) - 1, weights=new)[np.cumsum(new_key) - 1]
            # a first record of a suffix with one content only, inside the bucket, is settled
            give = repeat | new & (edge | (contents > 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[give]) for x in (repeat, edge & ~repeat, key.view(np.int64), content.view(np.int64), id_, packed)],
                ["repeat", "edge", "key", "content", "id", "packed"],
            )

    return judge


def _sorted_out(source: Callable, make: Callable, rows: float, texts: int, length: int, label: str, spark) -> DataFrame:
    """The judged records of ``source``, stored; ``rows`` is about how many records there are, ``texts`` how many texts.

    ``source`` gives the rows (id, text and so on) whose id meets a condition in SQL. Splitters are drawn from the records of some
    texts, ``SAMPLED_TEXTS`` at least: of all texts, where there are few and long ones.
    """
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(rows / BUCKET_ROWS) + 1)
    part = max(1, min(int(rows / 8 / SAMPLE_ROWS), texts // SAMPLED_TEXTS))  # eight times the sample before it is cut by hash

    def all_records(batches):
        for made in make(batches, length):
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[0].view(np.int64)), pa.array(made[1].view(np.int64)), pa.array(made[2]), pa.array(made[3])],
                ["key", "content", "id", "packed"],
            )

    sample = (
        source(f"pmod(xxhash64(id), {part}) = 0").mapInArrow(tidied(all_records), _RECORD)
        .orderBy(F.xxhash64("id", "packed")).limit(SAMPLE_ROWS).collect()
    )
    splitters = _splitters([tuple(r) for r in sample], buckets)
    dealt = source("true").mapInArrow(tidied(_dealt(make, splitters, length)), "bucket int, block binary")
    return stored(
        dealt.repartitionById(buckets, F.col("bucket")).mapInArrow(tidied(_judged(length)), _JUDGED), label
    )


def _across(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repeats (id, packed) and first records (key, content, id, packed) whose suffix has several contents.

    First records at the edges of buckets are compared across the boundaries here; there is one at most for each
    bucket and content.
    """
    edges = judged.where("NOT repeat AND edge")
    firsts = edges.groupBy("key", "content").agg(
        F.min(F.struct("id", F.shiftright("packed", 14).alias("low"), "packed")).alias("first")
    )
    several = firsts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    late = edges.join(firsts, ["key", "content"]).where(
        "id <> first.id OR shiftright(packed, 14) <> first.low"
    )
    repeats = judged.where("repeat").select("id", "packed").unionByName(late.select("id", "packed"))
    again = judged.where("NOT repeat AND NOT edge").select("id", "packed").unionByName(
        firsts.join(several, "key", "left_semi").select(F.col("first.id").alias("id"), F.col("first.packed").alias("packed"))
    )
    return repeats, again


def repeated_ranges(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Columns id and ranges (starts packed with the count of further starts) of strings that occur earlier.

    ``texts`` has id (long, not null) and text (binary).
    """
    total, many = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    spark = texts.sparkSession
    records = _sorted_out(texts.where, _records, 2 * total / (length - LEAD + 2), many, length, "suffix-records", spark)
    whole, again = _across(records)
    doubtful = stored(again.groupBy("id").agg(F.collect_list("packed").alias("packed")), "suffix-doubtful")
    strings, open_ = doubtful.agg(
        F.coalesce(F.sum(F.expr("aggregate(packed, 0L, (n, p) -> n + (shiftright(p, 7) & 127) + 1)")), F.lit(0)), F.count("*")
    ).first()

    def open_texts(condition: str) -> DataFrame:
        return texts.where(condition).join(doubtful.where(condition), "id")

    single, _ = _across(_sorted_out(open_texts, _strings, strings, open_, length, "suffix-strings", spark))
    return whole.unionByName(single).groupBy("id").agg(F.collect_list("packed").alias("ranges"))


def _readable(data: bytes) -> str:
    return data.decode("utf-8", "ignore")


def _kept(length: int, as_text: bool):
    given = _readable if as_text else bytes

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            out = []
            for text, ranges in zip(part.column("_climora_text").to_pylist(), part.column("_climora_ranges").to_pylist()):
                data = text or b""
                if not ranges:
                    out.append((len(data), 0, 0, given(data)))
                    continue
                packed = np.array(ranges, np.int64)
                low = packed >> 14
                high = low + (packed >> 7 & 127) + length
                fits = high <= len(data)
                depth = np.zeros(len(data) + 1, np.int64)
                np.add.at(depth, low[fits], 1)
                np.add.at(depth, high[fits], -1)
                gone = np.cumsum(depth[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                out.append((len(data), int(gone.sum()), spans, given(np.frombuffer(data, np.uint8)[~gone].tobytes())))
            columns = zip(*out) if out else ([], [], [], [])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string() if as_text else pa.binary())
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [c for n, c in zip(part.schema.names, part.columns) if not n.startswith("_climora_")] + arrays,
                [n for n in part.schema.names if not n.startswith("_climora_")] + ["n_bytes", "n_removed", "n_spans", "kept"],
            )

    return cut


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, carry: tuple[str, ...] = (), as_text: bool = False,
) -> DataFrame:
    """``id_col``, the columns of ``carry``, n_bytes, n_removed, n_spans and kept (binary) of each document.

    With ``as_text`` kept is a string, as ``readable`` makes it, from the same Python worker: a worker more for each core would stay for
    the jobs that follow.

    Removes every byte in a string of ``length`` bytes that also starts earlier: in a document of
    smaller id, or earlier in the same. Strings are judged on the input. Null and empty texts, and
    those shorter than ``length``, keep all. A null id stands before all others. Rows that repeat an
    id and text do not remove each other and give equal results; an id has to mean one text, and rows
    that share an id but not a text share the places that are removed. Bytes that are no UTF-8 count as they are. An
    empty table gives no rows.
    """
    if not LEAD <= length <= LEAD + 100:
        raise ValueError("the length has to be 40 to 140 bytes")
    small_batches(docs.sparkSession)
    id_ = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    data = F.col(text_col).cast("binary")
    ranges = repeated_ranges(docs.select(id_.alias("id"), data.alias("text")), length)
    carried = [F.col(id_col)] + [F.col(c) for c in carry]
    rows = docs.select(*carried, data.alias("_climora_text"), id_.alias("_climora_id"))
    joined = rows.join(
        ranges.select(F.col("id").alias("_climora_id"), F.col("ranges").alias("_climora_ranges")), "_climora_id", "left"
    )
    fields = [f for f in rows.schema.fields if not f.name.startswith("_climora_")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    kind = "string" if as_text else "binary"
    return joined.mapInArrow(tidied(_kept(length, as_text)), f"{schema}, n_bytes long, n_removed long, n_spans long, kept {kind}")


def readable(kept_col: str):
    """Bytes as text, without those of characters that were cut in two."""

    @pandas_udf(StringType())
    def text(values):
        import pandas as pd

        return pd.Series([None if v is None else _readable(bytes(v)) for v in values], dtype=object)

    return text(F.col(kept_col))
