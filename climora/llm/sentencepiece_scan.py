"""SentencePiece encoding and decoding, giant documents by a max-plus parallel scan.

A model of merged pieces joins neighbouring pieces by their scores, best first, leftmost on ties. What it ends in can be
told pair by pair: a row of pieces that spells the text is its encoding if and only if each two neighbours, encoded
alone, give themselves again. So the encoding is the one path through the lattice of all pieces on the text whose steps all weigh 0,
where a step between neighbours that would be joined differently weighs minus infinity.

No piece of a usable model holds a word start after other characters, so all paths meet at word starts: words are
encoded on their own, each distinct one of a stretch of text once, many at a time. A document of more than ``chunk`` characters is cut at
fixed places, wherever these fall. The state at a cut is the piece on the last character before it. Each chunk gives the
matrix of best weights from the states before it to those after it; matrices are combined associatively (in max-plus
algebra) to the weight of each state at each cut. Those tell for every state after a chunk the state before it on the
best path; these maps are combined from the right, and then each chunk is traced on its own between two known places.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType

from climora.llm.storage import parts_for, small_batches, stored, tidied

CHUNK = 16_384
GROUP = 64
# Blocks of the scan that one task combines.
CHUNKS_PER_TASK = 1024
_NEVER = -(2**62)
_NO_MERGE = -(2**31)
_REMEMBERED = 100_000
_UNITS_KEPT = 200_000
_SPACE = "▁"
_UNIT = re.compile(f"{_SPACE}+[^{_SPACE}]*|[^{_SPACE}]+")
# Units up to this length are segmented many at a time; characters that are looked up at once.
_WIDEST = 48
_CELLS = 200_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(47)


class _Numbers(dict):
    """Numbers of keys, in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        found = self[key] = len(self)
        return found


class Pieces:
    """Pieces of a model with byte fallback, their ids and scores."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.text = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.byte = [
            int(p[3:5], 16) if model.is_byte(i) else -1 for i, p in enumerate(self.text)
        ]
        self.of_byte = {b: i for i, b in enumerate(self.byte) if b >= 0}
        if len(self.of_byte) != 256:
            raise ValueError("the model has no pieces for single bytes")
        self.special = {i for i in range(len(self.text)) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.known: dict[str, tuple[int, int]] = {}
        for i, piece in enumerate(self.text):
            if self.byte[i] < 0 and i not in self.special:
                score = model.get_score(i)
                if score != int(score) or abs(score) >= -_NO_MERGE:
                    raise ValueError("scores have to be whole numbers of 32 bits")
                self.known[piece] = (i, int(score))
        if any(_SPACE in p.lstrip(_SPACE) for p in self.known):
            raise ValueError("pieces must not hold a word start after other characters")
        self.longest = max(map(len, self.known))
        self._pairs: dict[tuple[str, str], bool] = {}
        # what a piece decodes to by itself, but for bytes above ASCII
        self._alone = ["" if i in self.special else chr(b) if 0 <= b < 128 else p for i, (p, b) in enumerate(zip(self.text, self.byte))]
        self._high = np.array(self.byte) >= 128
        self._build_table()
        self._forget()

    def _build_table(self) -> None:
        """Hash table of the pieces for many lookups at once: buckets of a few slots, hash and id."""
        names = list(self.known)
        ids = np.array([self.known[p][0] for p in names], np.int32)
        hashes = np.zeros(len(names), np.uint64)
        for k in range(self.longest):
            at = [j for j, p in enumerate(names) if len(p) > k]
            codes = np.array([ord(names[j][k]) for j in at], np.uint64)
            hashes[at] = (hashes[at] ^ codes) * _STEP
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces share a hash")
        bucket = (hashes * _SPREAD >> _SHIFT).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        slot = np.arange(len(order)) - np.searchsorted(bucket[order], bucket[order])
        self._slots = int(slot.max()) + 1
        self._hash = np.zeros((self._slots, 1 << 64 - int(_SHIFT)), np.uint64)
        self._id = np.full(self._hash.shape, -1, np.int32)
        self._hash[slot, bucket[order]] = hashes[order]
        self._id[slot, bucket[order]] = ids[order]
        self._shared = np.bincount(bucket, minlength=self._hash.shape[1]) > 1
        self._score = np.full(len(self.text) + 1, _NO_MERGE, np.int32)  # the last is for none
        self._score[ids] = [self.known[p][1] for p in names]

    def _found(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -1 for none."""
        bucket = (hashes * _SPREAD >> _SHIFT).astype(np.int32)
        out = np.where(self._hash[0][bucket] == hashes, self._id[0][bucket], np.int32(-1))
        deep = np.nonzero(self._shared[bucket])
        bucket, wanted = bucket[deep], hashes[deep]
        found = out[deep]
        for slot in range(1, self._slots):
            hit = self._hash[slot][bucket] == wanted
            found[hit] = self._id[slot][bucket[hit]]
        out[deep] = found
        return out

    def joined(self, text: str) -> list[str]:
        """Pieces of a stretch of text, by merges from a heap; a character without a piece stands alone."""
        begin_of, end_of = list(range(-1, len(text))), list(range(1, len(text) + 2))  # begin of the piece that ends at, end of that at
        heap: list[tuple[int, int, int, int]] = []

        def offer(begin: int, middle: int, end: int) -> None:
            found = self.known.get(text[begin:end])
            if found is not None:
                heapq.heappush(heap, (-found[1], begin, middle, end))

        for at in range(1, len(text)):
            offer(at - 1, at, at + 1)
        gone = [False] * (len(text) + 1)
        while heap:
            _, begin, middle, end = heapq.heappop(heap)
            if gone[begin] or gone[middle] or (end < len(text) and gone[end]) or end_of[begin] != middle or end_of[middle] != end:
                continue
            gone[middle] = True
            end_of[begin], begin_of[end] = end, begin
            if begin:
                offer(begin_of[begin], begin, end)
            if end < len(text):
                offer(begin, end, end_of[end])
        out, at = [], 0
        while at < len(text):
            out.append(text[at : end_of[at]])
            at = end_of[at]
        return out

    def agree(self, left: str, right: str) -> bool:
        """Whether two neighbouring pieces, encoded alone, stay themselves."""
        found = self._pairs.get((left, right))
        if found is None:
            if len(self._pairs) >= _REMEMBERED:
                self._pairs.clear()
            found = self._pairs[left, right] = self.joined(left + right) == [left, right]
        return found

    def _same_length(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of units of one length: the unit of each token, and the tokens in order."""
        size, rows = len(units[0]), len(units)
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, size).astype(np.uint64)
        widest = min(size, self.longest)
        ids = np.full((rows, widest, size), -1, np.int32)  # of the stretch of each width and begin
        hashes = np.zeros(codes.shape, np.uint64)
        for width in range(1, widest + 1):
            hashes = (hashes[:, : size - width + 1] ^ codes[:, width - 1 :]) * _STEP
            ids[:, width - 1, : size - width + 1] = self._found(hashes)
        begin_of = np.tile(np.arange(-1, size, dtype=np.int32), (rows, 1))
        end_of = np.tile(np.arange(1, size + 2, dtype=np.int32), (rows, 1))
        there = np.ones((rows, size + 1), bool)
        offer = np.full((rows, size + 1), _NO_MERGE, np.int32)  # score of the merge at each boundary
        if size > 1:
            offer[:, 1:size] = self._score[ids[:, 1, : size - 1]]
        open_ = np.arange(rows)
        while len(open_):
            at = offer[open_].argmax(axis=1)  # the leftmost of the best
            going = offer[open_, at] > _NO_MERGE
            open_, at = open_[going], at[going]
            begin, end = begin_of[open_, at], end_of[open_, at]
            there[open_, at] = False
            offer[open_, at] = _NO_MERGE
            end_of[open_, begin] = end
            begin_of[open_, end] = begin
            for some, place, low, high in (
                (begin > 0, begin, begin_of[open_, begin], end), (end < size, end, begin, end_of[open_, np.minimum(end, size)])
            ):
                row, place, low, high = open_[some], place[some], low[some], high[some]
                fits = high - low <= widest
                score = np.full(len(row), _NO_MERGE, np.int32)
                score[fits] = self._score[ids[row[fits], high[fits] - low[fits] - 1, low[fits]]]
                offer[row, place] = score
        row, begin = np.nonzero(there[:, :size])
        token = ids[row, end_of[row, begin] - begin - 1, begin].astype(np.int64)
        raw = token < 0
        token[raw] = -1 - codes[row[raw], begin[raw]].astype(np.int64)
        return row, token

    def segment(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of many units one after another (ids; -1 - c for a character c without a piece), and their counts."""
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        of, token = [], []
        for size in np.unique(lengths):
            those = np.nonzero(lengths == size)[0]
            step = max(1, _CELLS // int(size)) if size <= _WIDEST else 1
            for at in range(0, len(those), step):
                some = those[at : at + step]
                if size <= _WIDEST:
                    row, found = self._same_length([units[j] for j in some])
                    of.append(some[row])
                else:
                    found = np.array([self.known[p][0] if p in self.known else -1 - ord(p) for p in self.joined(units[some[0]])], np.int64)
                    of.append(np.full(len(found), some[0]))
                token.append(found)
        if not of:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        of, token = np.concatenate(of), np.concatenate(token)
        order = np.argsort(of, kind="stable")
        return token[order], np.bincount(of, minlength=len(units))

    def _with_bytes(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens with unknown characters as pieces of their bytes, and the ids each token makes."""
        raw = np.nonzero(token < 0)[0]
        if not len(raw):
            return token.astype(np.int32), np.ones(len(token), np.int64)
        codes, inverse = np.unique(token[raw], return_inverse=True)
        spelled = [[self.of_byte[b] for b in chr(-1 - c).encode("utf-8", "replace")] for c in codes.tolist()]
        made = np.ones(len(token), np.int64)
        made[raw] = np.array([len(x) for x in spelled])[inverse]
        out = np.repeat(token, made)
        begin = np.cumsum(made) - made
        width = max(map(len, spelled))
        table = np.array([x + [-1] * (width - len(x)) for x in spelled])
        for k in range(width):
            some = raw[made[raw] > k]
            out[begin[some] + k] = table[inverse[made[raw] > k], k]
        return out.astype(np.int32), made

    def _forget(self) -> None:
        self._number = _Numbers()
        self._ids = np.zeros(0, np.int32)  # of all remembered units, one after another
        self._begin = np.zeros(1, np.int64)  # of each unit in them, and the end

    def _learn(self, units: list[str]) -> None:
        token, tokens = self.segment(units)
        ids, made = self._with_bytes(token)
        upto = np.concatenate(([0], np.cumsum(made)))[np.cumsum(tokens)]
        self._begin = np.concatenate((self._begin, self._begin[-1] + upto))
        self._ids = np.concatenate((self._ids, ids))

    def _units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of stretches of normalised text one after another, and how many each has.

        Stretches that begin a word and have single spaces are split by Arrow, where a word that
        comes again costs no Python object.
        """
        whole = pa.array(texts, pa.large_string())
        plain = pc.and_(pc.starts_with(whole, _SPACE), pc.invert(pc.match_substring(whole, 2 * _SPACE)))
        split = pc.split_pattern(whole.filter(plain), _SPACE)
        coded = split.flatten().dictionary_encode()
        number = self._number.__getitem__
        sign, nothing = (pa.scalar(x, pa.large_string()) for x in (_SPACE, ""))
        names = pc.binary_join_element_wise(sign, coded.dictionary, nothing).to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(number, names), np.int64, len(names))
        worded = np.ones(len(coded), bool)
        worded[split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()] = False  # what is before the first word
        is_plain, counts = plain.to_numpy(zero_copy_only=False), np.zeros(len(texts), np.int64)
        counts[is_plain] = pc.list_value_length(split).to_numpy() - 1
        others: list[int] = []
        for at in np.nonzero(~is_plain)[0].tolist():
            found = _UNIT.findall(texts[at])
            counts[at] = len(found)
            others.extend(map(number, found))
        unit = np.empty(counts.sum(), np.int64)
        of_plain = np.repeat(is_plain, counts)
        unit[of_plain] = numbers[coded.indices.to_numpy()[worded]]
        unit[~of_plain] = others
        return unit, counts

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches of normalised text one after another, and where each begins (and the last ends).

        A unit is segmented when it first occurs, and remembered for later texts.
        """
        if len(self._number) >= _UNITS_KEPT or len(self._number) != len(self._begin) - 1:
            self._forget()
        before = len(self._number)
        unit, counts = self._units(texts)
        self._learn(list(islice(self._number, before, None)))
        begin = self._begin[unit]
        sizes = self._begin[unit + 1] - begin
        upto = np.concatenate(([0], np.cumsum(sizes)))
        ids = self._ids[np.repeat(begin - upto[:-1], sizes) + np.arange(upto[-1])]
        return ids, upto[np.concatenate(([0], np.cumsum(counts)))]

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each of some stretches of normalised text."""
        ids, begin = self.encoded(texts)
        return np.split(ids, begin[1:-1]) if texts else []

    def decoded(self, ids: np.ndarray) -> str:
        """Text of ids: control pieces give none, bytes that are not UTF-8 give U+FFFD."""
        ids = np.asarray(ids, np.int64)
        alone, high = self._alone, self._high[ids]
        if high.any():  # neighbouring bytes above ASCII make characters together
            out, run = [], bytearray()
            for i, wide in zip(ids.tolist(), high.tolist()):
                if wide:
                    run.append(self.byte[i])
                    continue
                if run:
                    out.append(run.decode("utf-8", "replace"))
                    run = bytearray()
                out.append(alone[i])
            out.append(run.decode("utf-8", "replace"))
        else:
            out = [alone[i] for i in ids.tolist()]
        text = "".join(out).replace(_SPACE, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(2)
def pieces(model_file: str) -> Pieces:
    """The model, read once per worker."""
    return Pieces(model_file)


def normalised(text: str | None) -> str:
    """Text with a leading space, and spaces as the word-start sign; empty stays empty."""
    return _SPACE + text.replace(" ", _SPACE) if text else ""


def _parts(texts: Iterable[str], most: int = 4 << 20) -> Iterator[list[str]]:
    """Neighbouring texts of about ``most`` characters together."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def _lists(model: Pieces, texts: Iterable[str]) -> pa.ListArray:
    """Ids of each of some stretches of normalised text, as an Arrow array."""
    made = [model.encoded(part) for part in _parts(texts)]
    sizes = np.concatenate([[0], *(np.diff(begin) for _, begin in made)])
    values = np.concatenate([np.zeros(0, np.int32), *(ids for ids, _ in made)])
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(values, pa.int32()))


def states(model: Pieces, left: str, right: str) -> list[tuple[int, int]]:
    """Pieces that can lie on the last character of ``left``, as their begin and end in ``left + right``."""
    if not left:
        return [(0, 0)]
    text, n = left + right, len(left)
    return [
        (begin, end)
        for begin in range(max(0, n - model.longest), n)
        for end in range(n, min(begin + model.longest, len(text)) + 1)
        if text[begin:end] in model.known or end == begin + 1
    ]


def _reached(model: Pieces, text: str, entries: dict[tuple[int, int], np.ndarray], until: int) -> dict[tuple[int, int], np.ndarray]:
    """Weights of the pieces on the character before ``until`` (those that end there or after), from those of entry pieces."""
    weights, by_end = dict(entries), {}
    for span in entries:
        by_end.setdefault(span[1], []).append(span)
    for at in range(min(by_end, default=until), until):
        for span in by_end.get(at, ()):
            left = text[span[0] : span[1]]
            for end in range(at + 1, min(at + model.longest, len(text)) + 1):
                right = text[at:end]
                if right not in model.known and end > at + 1:
                    continue
                if left and not model.agree(left, right) or not left and model.joined(right) != [right]:
                    continue
                if (at, end) in weights:
                    weights[at, end] = np.maximum(weights[at, end], weights[span])
                else:
                    weights[at, end] = weights[span]
                    by_end.setdefault(end, []).append((at, end))
    return {span: w for span, w in weights.items() if span[0] < until <= span[1]}


def transfer(model: Pieces, context: str, body: str, ahead: str) -> np.ndarray:
    """Best weights from the states before ``body`` (rows) to those after it (columns)."""
    text, a = context + body + ahead, len(context)
    b = a + len(body)
    before, after = states(model, context, body + ahead), states(model, text[:b], ahead)
    out = np.full((len(before), len(after)), _NEVER, np.int64)
    unit = np.where(np.eye(len(before), dtype=bool), 0, _NEVER)
    enter = {span: unit[k] for k, span in enumerate(before)}
    starts = [m.start() for m in re.finditer(f"(?<!{_SPACE})(?={_SPACE})", text) if max(a, 1) <= m.start() < b]
    if not starts:
        ends = _reached(model, text, enter, b)
    else:
        first = _reached(model, text, enter, starts[0]) if starts[0] else enter
        sums = [w for span, w in first.items() if span[1] == starts[0]]
        through = np.max(sums, axis=0) if sums else np.full(len(before), _NEVER)
        ends = _reached(model, text, {(starts[-1], starts[-1]): through}, b)
    for k, span in enumerate(after):
        if span in ends:
            out[:, k] = ends[span]
    return out


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of a vector or matrix with a matrix."""
    a2 = np.atleast_2d(a)
    out = np.maximum((a2[:, :, None] + b[None, :, :].clip(_NEVER // 2)).max(axis=1), _NEVER)
    out = np.where(out <= _NEVER // 4, _NEVER, out)
    return out if a.ndim == 2 else out[0]


def _chunked(chunk: int, model_file: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = pieces(model_file).longest
        for batch in batches:
            for digest, text in zip(batch.column("digest").to_pylist(), batch.column("text").to_pylist()):
                whole = normalised(text)
                for c, at in enumerate(range(0, len(whole), chunk)):
                    yield pa.RecordBatch.from_pydict(
                        {"digest": [digest], "c": [c], "context": [whole[max(0, at - wide) : at]],
                         "body": [whole[at : at + chunk]], "ahead": [whole[at + chunk : at + chunk + wide]]},
                        pa.schema([("digest", pa.string()), ("c", pa.int32()), *((n, pa.string()) for n in ("context", "body", "ahead"))]),
                    )

    return cut


_INTS = ArrayType(IntegerType())


def _array(blob) -> np.ndarray:
    return np.frombuffer(blob, np.int64)


def _rows(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def _rowwise(make, inputs: tuple[str, ...], schema: pa.Schema):
    """A function for ``mapInArrow``: ``make`` turns the rows of a partition, in order, into rows of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = iter(make(_rows(batches, inputs)))
        while some := list(islice(made, 512)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)

    return run


def _scanned(blocks: DataFrame, whole, start: bytes, follow, backward: bool) -> DataFrame:
    """The state of each chunk (column state) by a scan over two levels.

    ``blocks`` has digest, c and block (bytes). ``whole(list of blocks)`` combines neighbours to one block; ``start`` is
    the state before all, and ``follow(state, block)`` that after a block. Groups hold ``GROUP`` chunks, of which a task holds one at a
    time: a text has fewer than 2^31 characters, hence no more than 2^31 / (GROUP * chunk) groups. Each level is dealt to
    tasks by the number of its blocks, whatever their bytes.
    """
    tasks = parts_for(blocks.count(), CHUNKS_PER_TASK)
    way = F.desc if backward else F.asc
    grouped = blocks.withColumn("g", F.expr(f"c div {GROUP}").cast("int"))

    def combine(rows: Iterable[tuple]) -> Iterator[tuple]:
        for (digest, g), run in groupby(rows, key=itemgetter(0, 1)):
            yield digest, g, whole([r[2] for r in run])

    def over_groups(rows: Iterable[tuple]) -> Iterator[tuple]:
        for digest, run in groupby(rows, key=itemgetter(0)):
            state = start
            for _, g, block in run:
                yield digest, g, state
                state = follow(state, block)

    def over_chunks(rows: Iterable[tuple]) -> Iterator[tuple]:
        for (digest, _), run in groupby(rows, key=itemgetter(0, 1)):
            state = None
            for _, _, c, block, entry in run:
                state = entry if state is None else state
                yield digest, c, state
                state = follow(state, block)

    def dealt(frame: DataFrame, many: int, keys: tuple[str, ...], last: str) -> DataFrame:
        return frame.repartition(many, *keys).sortWithinPartitions(*keys, way(last))

    text, number, data = (lambda n: (n, pa.string())), (lambda n: (n, pa.int32())), (lambda n: (n, pa.binary()))
    groups = dealt(grouped, tasks, ("digest", "g"), "c").mapInArrow(
        _rowwise(combine, ("digest", "g", "block"), pa.schema([text("digest"), number("g"), data("block")])), "digest string, g int, block binary"
    )
    entering = dealt(groups, parts_for(tasks, GROUP), ("digest",), "g").mapInArrow(
        _rowwise(over_groups, ("digest", "g", "block"), pa.schema([text("digest"), number("g"), data("state")])), "digest string, g int, state binary"
    )
    joined = dealt(grouped.join(entering, ["digest", "g"]), tasks, ("digest", "g"), "c")
    return joined.mapInArrow(
        _rowwise(over_chunks, ("digest", "g", "c", "block", "state"), pa.schema([text("digest"), number("c"), data("state")])),
        "digest string, c int, state binary",
    )


def _packed(matrix: np.ndarray) -> bytes:
    return np.int64(matrix.shape[0]).tobytes() + matrix.astype(np.int64).tobytes()


def _matrix(block: bytes) -> np.ndarray:
    return _array(block)[1:].reshape(int(_array(block)[0]), -1)


def _matrix_product(blocks: list[bytes]) -> bytes:
    out = _matrix(blocks[0])
    for block in blocks[1:]:
        out = times(out, _matrix(block))
    return _packed(out)


def _vector_product(vector: bytes, block: bytes) -> bytes:
    return times(_array(vector), _matrix(block)).tobytes()


def _map_product(blocks: list[bytes]) -> bytes:
    out = _array(blocks[0])
    for block in blocks[1:]:
        out = _array(block)[out]
    return out.tobytes()


def _map_state(state: bytes, block: bytes) -> bytes:
    return _array(block)[_array(state)].tobytes()


def _entry(block: bytes, vector: bytes, last: bool) -> bytes:
    """For each state after a chunk the best state before it; after the last chunk, for the best state only."""
    sums = np.maximum(_matrix(block), _NEVER // 2) + np.maximum(_array(vector), _NEVER // 2)[:, None]
    found = sums.argmax(axis=0)
    return (found[[sums.max(axis=0).argmax()]] if last else found).astype(np.int64).tobytes()


def _per_chunk(work, schema: list[tuple[str, pa.DataType]], inputs: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("digest").to_pylist(), batch.column("c").to_pylist())
            values = zip(*(batch.column(n).to_pylist() for n in inputs))
            made = [(d, c, work(*v)) for (d, c), v in zip(keys, values)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[k] for m in made], kind) for k, (_, kind) in enumerate(schema)], [n for n, _ in schema]
            )

    return run


def _giant_ids(giants: DataFrame, model_file: str, chunk: int) -> DataFrame:
    """Columns digest and ids for distinct texts (digest, text)."""
    key = [("digest", pa.string()), ("c", pa.int32())]
    chunks = stored(
        giants.mapInArrow(tidied(_chunked(chunk, model_file)), "digest string, c int, context string, body string, ahead string"), "pieces-chunks"
    )
    texts = ("context", "body", "ahead")
    matrices = stored(
        chunks.repartition("digest", "c").mapInArrow(
            tidied(_per_chunk(lambda *t: _packed(transfer(pieces(model_file), *t)), [*key, ("block", pa.binary())], texts)),
            "digest string, c int, block binary",
        ),
        "pieces-matrices",
    )
    vectors = _scanned(matrices, _matrix_product, np.zeros(1, np.int64).tobytes(), _vector_product, False)
    last = matrices.groupBy("digest").agg(F.max("c").alias("c"), F.lit(True).alias("last"))
    maps = stored(
        matrices.join(vectors, ["digest", "c"]).join(last, ["digest", "c"], "left").withColumn("last", F.coalesce("last", F.lit(False)))
        .mapInArrow(_per_chunk(_entry, [*key, ("block", pa.binary())], ("block", "state", "last")), "digest string, c int, block binary"),
        "pieces-maps",
    )
    exits = _scanned(maps, _map_product, np.zeros(1, np.int64).tobytes(), _map_state, True)
    ends = stored(
        maps.join(exits, ["digest", "c"]).join(last, ["digest", "c"], "left")
        .select("digest", "c", "block", "state", F.coalesce("last", F.lit(False)).alias("last")),
        "pieces-ends",
    )

    def between(context, body, ahead, block, state, last):
        model, text, a = pieces(model_file), context + body + ahead, len(context)
        leave = int(_array(state)[0])
        begin = states(model, context, body + ahead)[int(_array(block)[leave])][1]
        end = len(text) if last else states(model, text[: a + len(body)], ahead)[leave][1]
        return text[begin:end]

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_ = (between(*row) for row in zip(*(batch.column(n).to_pylist() for n in (*texts, "block", "state", "last"))))
            ids = _lists(pieces(model_file), texts_)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("c"), ids], ["digest", "c", "ids"])

    traced = chunks.join(ends, ["digest", "c"]).mapInArrow(tidied(trace), "digest string, c int, ids array<int>")
    return traced.groupBy("digest").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("c", "ids"))), lambda x: x["ids"])).alias("ids")
    )


def encode(docs: DataFrame, model_file: str, text_col: str = "text", out_col: str = "ids", chunk: int = CHUNK) -> DataFrame:
    """``docs`` with the piece ids of ``text_col`` as ``out_col`` (array of int).

    Null and empty texts give an empty array; bytes that are no UTF-8 are encoded as the replacement character. ``out_col`` replaces a column of that name. Texts of
    ``chunk`` characters and more go through the parallel scan, equal ones once; all others are
    encoded in the task that reads them. Both give the same ids. Repeated rows stay as they are.
    """

    @arrow_udf(_INTS)
    @tidied
    def small(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield _lists(pieces(model_file), map(normalised, texts.to_pylist()))

    small_batches(docs.sparkSession)
    text = F.make_valid_utf8(text_col)
    size = F.coalesce(F.char_length(text), F.lit(0))
    digest = F.sha2(text.cast("binary"), 256)
    giants = docs.where(size >= chunk)
    distinct = giants.select(digest.alias("digest"), text.alias("text")).dropDuplicates(["digest"])
    found = stored(_giant_ids(distinct, model_file, chunk), "pieces-ids").select(
        F.col("digest").alias("_climora_digest"), F.col("ids").alias("_climora_ids")
    )
    kept = [c for c in docs.columns if c != out_col]
    joined = giants.withColumn("_climora_key", digest).join(found, F.col("_climora_key") == F.col("_climora_digest"))
    return docs.where(size < chunk).withColumn("_climora_ids", small(text)).select(
        *[F.col(f"`{c}`") for c in kept], F.col("_climora_ids").alias(out_col)
    ).unionByName(joined.select(*[F.col(f"`{c}`") for c in kept], F.col("_climora_ids").alias(out_col)))


def decode(frame: DataFrame, model_file: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``frame`` with the text of ``ids_col`` as ``out_col``; null and empty arrays give empty texts."""

    @arrow_udf(StringType())
    def text(arrays: pa.Array) -> pa.Array:
        model, ids = pieces(model_file), arrays.values.to_numpy(zero_copy_only=False)
        begin, size = arrays.offsets.to_numpy(), pc.fill_null(pc.list_value_length(arrays), 0).to_numpy()
        return pa.array([model.decoded(ids[b : b + n]) for b, n in zip(begin.tolist(), size.tolist())], pa.string())

    small_batches(frame.sparkSession)
    return frame.withColumn(out_col, text(F.col(ids_col)))
