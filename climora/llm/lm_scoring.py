"""Language-model scores by masked pseudo-likelihood.

Every word is predicted from the two words on either side of it. Words are hashed to buckets; counts of all buckets over the whole
corpus put them into classes (frequent ones alone, the rest in classes of equal size). A network with a hidden layer gives the
class from the classes around it, and the counts give the bucket within its class. The network is trained in numpy, by tasks that
each go through their part of a slice of the documents and whose weights are averaged after each slice, until every document has
been used. The score of a document is
the sum of the log-probabilities of its words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climora.llm.storage import dropped, small_batches, stored

BUCKETS = 1 << 16
CLASSES = 128
ALONE = 64
HIDDEN = 32
AROUND = (-2, -1, 1, 2)
#: Of so many slices of the documents, by a hash of the id, each round trains on one; there are as many rounds as slices.
SLICES = 16
# Words scored at once: what is worked out for them stays in a core's own cache.
_BLOCK = 512
_PAD = CLASSES


def words_of(text: str | None) -> np.ndarray:
    """Buckets of the lower-cased words of a text."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) & BUCKETS - 1


def _numbers(held: bytes) -> np.ndarray:
    """Buckets of a text as they are stored: two bytes per word."""
    return np.frombuffer(held, "<u2").astype(np.int64)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = [words_of(t).astype("<u2").tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("slice"), pa.array(held, pa.binary())], ["id", "slice", "held"])


def bucketed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slices: int = SLICES) -> DataFrame:
    """The buckets of all documents (id, slice, held), stored: texts are taken apart once, for counting, training and scoring."""
    plain = docs.select(
        F.col(id_col).alias("id"), F.pmod(F.xxhash64(id_col), F.lit(slices)).cast("int").alias("slice"), F.make_valid_utf8(text_col).alias("text")
    )
    kind = plain.schema["id"].dataType.simpleString()
    return stored(plain.mapInArrow(_held, f"id {kind}, slice int, held binary"), "lm-buckets", "slice")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        total += np.bincount(_numbers(b"".join(batch.column("held").to_pylist())), minlength=BUCKETS)
    met = np.nonzero(total)[0]
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])


def _sums(rows: DataFrame) -> np.ndarray:
    sums = rows.select("held").mapInArrow(_counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in sums.collect():  # BUCKETS rows at most
        out[row.bucket] = row.n
    return out


def bucket_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each bucket is in all documents; each task sends one row per bucket it has met."""
    plain = docs.select(F.lit(0).alias("id"), F.lit(0).alias("slice"), F.make_valid_utf8(text_col).alias("text"))
    return _sums(plain.mapInArrow(_held, "id int, slice int, held binary"))


def classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each bucket, and the log-probability of the bucket within it (one added to each count)."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    of = np.empty(len(counts), np.int64)
    of[order[:ALONE]] = np.arange(ALONE)
    of[order[ALONE:]] = ALONE + np.arange(len(counts) - ALONE) % (CLASSES - ALONE)
    return of, np.log((counts + 1) / np.bincount(of, weights=counts + 1, minlength=CLASSES)[of])


_SHAPES = ((len(AROUND), CLASSES + 1, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,))
_SIZES = [int(np.prod(s)) for s in _SHAPES]


def unpacked(flat: np.ndarray) -> list[np.ndarray]:
    """The weights of the network as views of one array."""
    return [x.reshape(s) for x, s in zip(np.split(flat, np.cumsum(_SIZES)[:-1]), _SHAPES)]


def start_weights(counts: np.ndarray, of: np.ndarray, seed: int = 5) -> np.ndarray:
    """Weights before training: the frequencies of the classes, and noise."""
    rng = np.random.default_rng(seed)
    flat = np.concatenate([rng.normal(0, 0.1, n) for n in _SIZES]).astype(np.float32)
    sums = np.bincount(of, weights=counts + 1.0, minlength=CLASSES)
    unpacked(flat)[1][:], unpacked(flat)[3][:] = 0, np.log(sums / sums.sum())
    return flat


def _windows(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Targets, and the classes around each; documents do not see each other."""
    pad = np.full(2, _PAD, np.int64)
    whole = np.concatenate([x for p in parts for x in (pad, p, pad)] or [pad])
    at = np.nonzero(whole != _PAD)[0]
    return whole[at], np.stack([whole[at + k] for k in AROUND], axis=1) if len(at) else np.zeros((0, len(AROUND)), np.int64)


def _hidden(weights: list[np.ndarray], around: np.ndarray) -> np.ndarray:
    total = weights[0][0].take(around[:, 0], axis=0)
    total += weights[1]
    for k in range(1, len(AROUND)):
        total += weights[0][k].take(around[:, k], axis=0)
    return np.tanh(total, out=total)


def _logits(weights: list[np.ndarray], hidden: np.ndarray) -> np.ndarray:
    """Logits of all classes, each row less its largest."""
    logits = hidden @ weights[2]
    logits += weights[3]
    half = logits
    while half.shape[1] > 8:  # the larger of both halves, for many rows at once
        half = np.maximum(half[:, : half.shape[1] // 2], half[:, half.shape[1] // 2 :])
    logits -= half.max(axis=1, keepdims=True)
    return logits


def log_probabilities(flat: np.ndarray, target: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Log-probability of each target class."""
    weights, out, rows = unpacked(flat), np.empty(len(target)), np.arange(_BLOCK)
    for at in range(0, len(target), _BLOCK):
        part = slice(at, at + _BLOCK)
        logits = _logits(weights, _hidden(weights, around[part]))
        picked = logits[rows[: len(logits)], target[part]]
        out[part] = picked - np.log(np.exp(logits, out=logits).sum(axis=1))
    return out


def train(flat: np.ndarray, target: np.ndarray, around: np.ndarray, rate: float, squares: np.ndarray, batch: int = 512) -> None:
    """One pass of gradient steps over the rows, scaled by the running squares; changes ``flat``."""
    weights, steps = unpacked(flat), unpacked(squares)
    rows, shift = np.arange(batch), np.arange(len(AROUND)) * (CLASSES + 1)
    held = np.zeros((len(AROUND) * (CLASSES + 1), batch), np.float32)  # which class is where around each word; emptied again after each step
    for at in range(0, len(target), batch):
        y, x = target[at : at + batch], around[at : at + batch]
        own = rows[: len(y)]
        hidden = _hidden(weights, x)
        off = _logits(weights, hidden)
        np.exp(off, out=off)
        off /= off.sum(axis=1, keepdims=True)
        off[own, y] -= 1
        off /= len(y)
        inner = (off @ weights[2].T) * (1 - hidden**2)
        met = (x + shift, own[:, None])
        held[met] = 1
        table = (held[:, : len(y)] @ inner).reshape(weights[0].shape)
        held[met] = 0
        for w, s, g in zip(weights, steps, (table, inner.sum(axis=0), hidden.T @ off, off.sum(axis=0))):
            s += g * g
            w -= rate * g / (np.sqrt(s) + 1e-6)


def _trained(flat: np.ndarray, of: np.ndarray, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, squares, seen = flat.copy(), np.full(len(flat), 1e-4, np.float32), 0
        for batch in batches:
            held = batch.column("held").to_pylist()
            for at in range(0, len(held), 64):
                target, around = _windows([of[_numbers(h)] for h in held[at : at + 64]])
                order = np.random.default_rng(seen).permutation(len(target))
                train(own, target[order], around[order], rate, squares)
                seen += len(target)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(own), dtype=np.int32)), pa.array(own.astype(float) * seen), pa.array(np.full(len(own), float(seen)))],
                ["k", "sum", "n"],
            )

    return run


def fit_network(docs: DataFrame, counts: np.ndarray, id_col: str = "doc_id", text_col: str = "text", slices: int = SLICES, rounds: int | None = None) -> np.ndarray:
    """Weights trained on each of ``slices`` slices, or the first ``rounds``; a weight is averaged over tasks by the words they have seen."""
    rows = bucketed(docs, id_col, text_col, slices)
    flat = _fitted(rows, counts, slices, rounds)
    dropped(rows)
    return flat


def _fitted(rows: DataFrame, counts: np.ndarray, slices: int, rounds: int | None) -> np.ndarray:
    of, _ = classes(counts)
    flat = start_weights(counts, of)
    for turn in range(slices if rounds is None else rounds):
        part = rows.where(F.col("slice") == turn).select("held")
        sums = part.mapInArrow(_trained(flat, of, 0.1 / (1 + turn)), "k int, sum double, n double").groupBy("k").agg(
            (F.sum("sum") / F.sum("n")).alias("mean")
        )
        new = sums.collect()  # as many rows as the network has weights, none without words
        if new:
            flat = flat.copy()
            flat[[r.k for r in new]] = np.array([r.mean for r in new], np.float32)
    return flat


def _scored(flat: np.ndarray, of: np.ndarray, within: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("held").to_pylist()
            sizes, sums = [], []
            for at in range(0, len(held), 64):
                words = [_numbers(h) for h in held[at : at + 64]]
                target, around = _windows([of[w] for w in words])
                per_word = log_probabilities(flat, target, around) + within[np.concatenate(words)] if len(target) else np.zeros(0)
                lengths = np.array([len(w) for w in words])
                upto = np.concatenate(([0.0], np.cumsum(per_word)))
                ends = np.cumsum(lengths)
                sizes.append(lengths)
                sums.append(upto[ends] - upto[ends - lengths])
            n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n.astype(np.int64)), pa.array(np.concatenate(sums) if sums else np.zeros(0))], ["id", "n_words", "log_likelihood"]
            )

    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slices: int = SLICES, rounds: int | None = None) -> DataFrame:
    """One row per document: ``id_col``, n_words, log_likelihood (sum over words) and mean_log_likelihood (null without words).

    Null and empty texts have no words and a sum of 0. Repeated rows give repeated results; an empty table gives none; other columns are not read.
    Bytes that are no UTF-8 read as the replacement character.
    """
    small_batches(docs.sparkSession)
    rows = bucketed(docs, id_col, text_col, slices)
    counts = _sums(rows)
    of, within = classes(counts)
    flat = _fitted(rows, counts, slices, rounds)
    id_kind = rows.schema["id"].dataType.simpleString()
    scored = rows.select("id", "held").mapInArrow(_scored(flat, of, within), f"id {id_kind}, n_words long, log_likelihood double")
    return scored.select(
        F.col("id").alias(id_col), "n_words", "log_likelihood",
        F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")).alias("mean_log_likelihood"),
    )
