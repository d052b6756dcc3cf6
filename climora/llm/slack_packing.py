"""Packing documents into token sequences by minimum bin slack.

What a document has beyond its full sequences is one number, its remaining length, so a corpus of any size is a
histogram of ``capacity`` counts. Windows are planned on that histogram: the longest remaining length opens a window, and
a subset-sum over a bitset (bit s: some multiset of remaining lengths sums to s) tells the multiset that fills the rest
closest to capacity, read back with the count of each length. A multiset is used as often as the counts allow, so there
are about as many different windows as lengths, whatever the number of documents. Where no multiset fills a window, the
longest document left is cut to fill it, and its rest goes back to the histogram.

Which document fills which place follows from its rank among the documents of its length. Ranks are counted within
tasks and moved by the counts of the tasks before, so no length has to fit into one task.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climora.llm.storage import small_batches, stored

# Characters that are split and looked up at once; words that a worker remembers, and the longest of these.
_STRETCH = 4_000_000
_WORDS_KEPT = 300_000
_LONGEST_KEPT = 64
# Letters that lower-casing and composing leave as they are.
_LETTERS = re.compile("[a-zà-öø-ÿ]+")
# Kinds of bytes: 0 white space, 1 letter or digit, 2 sign but for the apostrophe, 3 anything else.
_KIND = np.full(256, 3, np.uint8)
_KIND[33:127] = 2
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
_KIND[39] = 3
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LATIN = 0xC3  # first byte of U+00C0 to U+00FF; capitals are 32 below their small letters there too, up to U+00DE
_COMBINING = 0xCC  # first byte of U+0300 and above
_PIECE = "array<struct<start:bigint,length:bigint,sequence_id:bigint,offset:bigint>>"


@dataclass(frozen=True)
class Place:
    """Where the documents ``lo`` to ``hi`` (excluded) of remaining length ``origin`` put ``length`` ids from ``start`` on.

    The one of rank r is number j = first + r - lo of its place, and goes to window ``window + j // per`` at
    ``offset + j % per * length``.
    """

    origin: int
    lo: int
    hi: int
    start: int
    length: int
    window: int
    first: int
    per: int
    offset: int


def closest_fill(counts: list[tuple[int, int]], room: int) -> dict[int, int]:
    """The multiset of lengths with the largest sum up to ``room``, as count by length.

    ``counts`` holds (length, how many there are), longest first. Among equal sums, long ones are taken.
    """
    mask = (1 << room + 1) - 1
    reach, steps = 1, []
    for length, have in counts:
        if length > room:
            continue
        steps.append((length, min(have, room // length), reach))
        left, many = steps[-1][1], 1
        while left:
            reach |= reach << min(many, left) * length
            left -= min(many, left)
            many *= 2
        reach &= mask
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, most, before in reversed(steps):
        used = next(m for m in range(most + 1) if m * length <= total and before >> total - m * length & 1)
        if used:
            chosen[length] = used
            total -= used * length
    return chosen


class _Pools:
    """Documents, or what is left of them, by remaining length: queues of [origin, lo, count, start]."""

    def __init__(self, counts: dict[int, int]):
        self.queues = {n: deque([[n, 0, c, 0]]) for n, c in counts.items() if c}
        self.have = {n: c for n, c in counts.items() if c}

    def take(self, length: int, many: int) -> Iterator[tuple[int, int, int, int]]:
        self.have[length] -= many
        queue = self.queues[length]
        while many:
            origin, lo, count, start = queue[0]
            part = min(count, many)
            yield origin, lo, part, start
            many -= part
            if part == count:
                queue.popleft()
            else:
                queue[0] = [origin, lo + part, count - part, start]
        if not self.have[length]:
            del self.have[length], self.queues[length]

    def put(self, length: int, origin: int, lo: int, count: int, start: int) -> None:
        self.queues.setdefault(length, deque()).append([origin, lo, count, start])
        self.have[length] = self.have.get(length, 0) + count


def plan_windows(counts: dict[int, int], capacity: int) -> tuple[list[Place], int]:
    """Places for all remaining lengths (1 to ``capacity - 1``), and the number of sequences that they take.

    All sequences are full but those of the last tokens, which are dealt to sequences of falling powers of two.
    """
    pools, places, window = _Pools(counts), [], 0
    while pools.have:
        lengths = sorted(pools.have, reverse=True)
        seed = lengths[0]
        pools.have[seed] -= 1
        fill = closest_fill([(n, pools.have[n]) for n in lengths if pools.have[n]], capacity - seed)
        pools.have[seed] += 1
        need = dict(fill)
        need[seed] = need.get(seed, 0) + 1
        slack = capacity - sum(n * m for n, m in need.items())
        cut = next((n for n in lengths if pools.have[n] > need.get(n, 0)), None) if slack else None
        if slack and cut is None:  # these are the last documents
            return places + _last(pools, lengths, window, capacity - slack), window + (capacity - slack).bit_count()
        together = need if cut is None else need | {cut: need.get(cut, 0) + 1}
        times = min(pools.have[n] // m for n, m in together.items())
        offset = 0
        for length, per in sorted(need.items(), reverse=True):
            first = 0
            for origin, lo, count, start in pools.take(length, per * times):
                places.append(Place(origin, lo, lo + count, start, length, window, first, per, offset))
                first += count
            offset += per * length
        if cut is not None:
            first = 0
            for origin, lo, count, start in list(pools.take(cut, times)):
                places.append(Place(origin, lo, lo + count, start, slack, window, first, 1, offset))
                pools.put(cut - slack, origin, lo, count, start + slack)
                first += count
        window += times
    return places, window


def _last(pools: _Pools, lengths: list[int], window: int, total: int) -> list[Place]:
    """Less than one window: its documents one after another, cut where a power of two is full."""
    sizes = [1 << k for k in reversed(range(total.bit_length())) if total >> k & 1]
    places, at = [], 0
    for length in lengths:
        for origin, lo, count, start in list(pools.take(length, pools.have[length])):
            for rank in range(lo, lo + count):
                done = 0
                while done < length:
                    part = min(length - done, sizes[0] - at)
                    places.append(Place(origin, rank, rank + 1, start + done, part, window, 0, 1, at))
                    done, at = done + part, at + part
                    if at == sizes[0]:
                        sizes, at, window = sizes[1:], 0, window + 1
    return places


class _Memory(dict):
    """The latest entries, at least ``most`` and up to twice as many: what is asked for again stays."""

    def __init__(self, most: int):
        self.most, self.before = most, {}

    def __missing__(self, key: str) -> bytes | None:
        """An entry of the generation before moves to this one; None if there is none."""
        found = self.before.get(key)
        if found is not None:
            self.keep(key, found)
        return found

    def keep(self, key: str, value: bytes) -> bytes:
        if len(key) <= _LONGEST_KEPT:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[key] = value
        return value


class _Encoder:
    """Ids of words, remembered by a worker. For tokenizers that lower-case, drop white space and merge bytes within words."""

    def __init__(self, tokenizer_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks run side by side as it is
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        parts = json.loads(self.tokenizer.to_str())
        normal, before = parts["normalizer"] or {}, parts["pre_tokenizer"] or {}
        kinds = [[x["type"] for x in y] for y in (normal.get("normalizers", []), before.get("pretokenizers", []))]
        pattern = (before.get("pretokenizers", [{}])[0].get("pattern") or {}).get("Regex", "")
        if kinds != [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] or not pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"):
            raise ValueError("the tokenizer has to lower-case, and to split at white space, digits and signs")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the vocabulary
        hidden = [b for b in range(256) if b not in set(shown)]
        self.byte = {b: 256 + k for k, b in enumerate(hidden)}
        self.words = _Memory(_WORDS_KEPT)

    def _word(self, word: str) -> bytes:
        if _LETTERS.fullmatch(word):
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.byte)
            ids = [x.id for x in self.model.tokenize(spelled)]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, words: Iterable[str]) -> list[bytes]:
        known = self.words
        return [ids if (ids := known[w]) is not None else known.keep(w, self._word(w)) for w in words]


@lru_cache(maxsize=2)
def _encoder(tokenizer_file: str) -> _Encoder:
    return _Encoder(tokenizer_file)


def _stretches(text: str) -> Iterator[str]:
    """The text cut at white space into parts of a bounded length; a longer word stays whole."""
    at = 0
    while len(text) - at > _STRETCH:
        cut = max(text.rfind(c, at, at + _STRETCH) for c in " \n\t\r")
        if cut <= at:
            found = [k for c in " \n\t\r" if (k := text.find(c, at + _STRETCH)) >= 0]
            cut = min(found, default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def _split(parts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, and where each text's words begin.

    Words end at ASCII white space. Where a text holds neither characters from U+0300 on nor a special token, its letters up to U+00FF
    are lower-cased, and words also end between a letter or digit and a sign, as no id spans these.
    """
    raw = [p.encode() for p in parts]
    starts = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    kind, text = _KIND[data], _LOWER[data]
    second = np.nonzero(data == _LATIN)[0] + 1
    second = second[(data[second] != 0x97) & (data[second] != 0xB7)]  # no letters: × and ÷
    kind[second - 1] = kind[second] = 1
    text[second[data[second] < 0x9F]] += 32
    odd = np.nonzero((data >= _COMBINING) | (data == 60) & (np.concatenate((data[1:], data[:1])) == 124))[0]
    for k in np.unique(np.searchsorted(starts, odd, "right") - 1):
        at = slice(starts[k], starts[k + 1])
        kind[at] = np.where(kind[at] > 0, 3, 0)
        text[at] = data[at]
    before = np.concatenate((np.zeros(1, np.uint8), kind[:-1]))
    solid = kind > 0
    begins = np.nonzero(solid & ((before == 0) | (before * kind == 2)))[0]
    offsets = np.concatenate((np.cumsum(solid)[begins] - 1, [solid.sum()])).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(text[solid]))
    return words, np.searchsorted(begins, starts)


def _encoded(parts: list[str], tokenizer_file: str) -> list[np.ndarray]:
    """Ids of each text; each distinct word of all is looked up once."""
    words, bounds = _split(parts)
    coded = words.dictionary_encode()
    ids = _encoder(tokenizer_file).ids(coded.dictionary.to_numpy(zero_copy_only=False))
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), "<u4")
    code = coded.indices.to_numpy()
    wide = size[code]
    ends = np.concatenate(([0], np.cumsum(wide)))
    spots = np.repeat((np.cumsum(size) - size)[code] - ends[:-1], wide) + np.arange(ends[-1])
    out, bounds = flat[spots], ends[bounds]
    return [out[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _in_turn(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """Parts of the texts with the number of their text, a bounded number of characters at a time."""
    held, size = [], 0
    for k, text in enumerate(texts):
        for part in _stretches(text):
            if held and size + len(part) > _STRETCH:
                yield held
                held, size = [], 0
            held.append((k, part))
            size += len(part)
    if held:
        yield held


def _tokenized(docs: DataFrame, tokenizer_file: str, capacity: int, end_id: int) -> DataFrame:
    """Ids (little-endian unsigned 32-bit) and token count of each document, and its ranks within the task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        ranks, before = np.zeros(capacity, np.int64), 0
        end = np.array([end_id], "<u4")
        for batch in batches:
            texts = batch["text"].to_pylist()
            found: list[list[np.ndarray]] = [[] for _ in texts]
            for group in _in_turn(texts):
                for (k, _), ids in zip(group, _encoded([part for _, part in group], tokenizer_file)):
                    found[k].append(ids)
            rows = []
            for parts in found:
                ids = np.concatenate([*parts, end])
                full, rest = divmod(len(ids), capacity)
                rows.append((ids.tobytes(), len(ids), full, rest, task, ranks[rest], before))
                ranks[rest] += 1
                before += full
            made = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *made], names=names)

    kinds = [pa.binary(), *[pa.int64()] * 6]
    names = ["doc_id", "ids", "doc_tokens", "full", "rest", "task", "rank", "before"]
    plain = docs.select("doc_id", F.make_valid_utf8(F.coalesce("text", F.lit(""))).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, ids binary, " + ", ".join(f"{n} bigint" for n in names[2:]))


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces of all documents in sequences of ``capacity`` ids: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers. A document is its text's ids and ``end_id``;
    its first full sequences stand alone, the rest is packed as the module says. All sequences are full, but for the last
    tokens of all: these are dealt to sequences of different powers of two, so nothing is padded.

    A null text counts as empty, bytes that are no UTF-8 as the replacement character. An empty text is its end id.
    Repeated rows, and rows of one doc_id (null included) with different texts, are packed each on its own. Other columns are left
    out. Which of several documents of one length takes which place depends on the order of the rows. No rows give no pieces.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tokens = stored(_tokenized(docs, tokenizer_file, capacity, end_id), "packing-ids")
    counts = stored(
        tokens.groupBy("task", "rest").agg(F.count("*").alias("documents"), F.sum("full").alias("fulls")), "packing-counts"
    )
    # One number per length: at most ``capacity`` rows.
    histogram = {r[0]: r[1] for r in counts.where("rest > 0").groupBy("rest").agg(F.sum("documents")).collect()}
    places, windows = plan_windows(histogram, capacity)
    plan = _plan_frame(spark, places)
    earlier = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    full_before = counts.groupBy("task").agg(F.sum("fulls").alias("n")).select(
        "task", F.coalesce(F.sum("n").over(tasks), F.lit(0)).alias("task_fulls")
    )
    firsts = counts.select("task", "rest", F.coalesce(F.sum("documents").over(earlier), F.lit(0)).alias("first")).join(full_before, "task")
    whole = F.when(F.col("full") > 0, F.transform(F.sequence(F.lit(0), F.col("full") - 1), lambda k: F.struct(
        (k * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"),
        (F.lit(windows) + F.col("task_fulls") + F.col("before") + k).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    ))).otherwise(F.array().cast(_PIECE))
    place = F.col("first") + F.col("rank")
    packed = F.transform(
        F.filter("places", lambda p: (p["lo"] <= place) & (place < p["hi"])),
        lambda p: F.struct(
            (F.col("full") * capacity + p["start"]).alias("start"), p["length"].alias("length"),
            (p["window"] + F.floor((p["first"] + place - p["lo"]) / p["per"])).alias("sequence_id"),
            (p["offset"] + (p["first"] + place - p["lo"]) % p["per"] * p["length"]).alias("offset"),
        ),
    )
    # The plan has one row per length, and its size does not grow with the documents.
    placed = tokens.join(firsts, ["task", "rest"]).join(F.broadcast(plan), "rest", "left")
    pieces = placed.select(
        "doc_id", "ids", "doc_tokens", F.explode(F.concat(whole, F.coalesce(packed.cast(_PIECE), F.array().cast(_PIECE)))).alias("piece")
    )
    at, size = F.col("piece.start").cast("int"), F.col("piece.length").cast("int")
    return pieces.select(
        "doc_id", "piece.start", "piece.length", F.substring("ids", at * 4 + 1, size * 4).alias("ids"),
        "doc_tokens", "piece.sequence_id", "piece.offset",
    )


def _plan_frame(spark, places: list[Place]) -> DataFrame:
    by_length: dict[int, list[tuple]] = {}
    for p in places:
        by_length.setdefault(p.origin, []).append((p.lo, p.hi, p.start, p.length, p.window, p.first, p.per, p.offset))
    entry = ",".join(f"{n}:bigint" for n in ("lo", "hi", "start", "length", "window", "first", "per", "offset"))
    return spark.createDataFrame(sorted(by_length.items()), f"rest bigint, places array<struct<{entry}>>")
