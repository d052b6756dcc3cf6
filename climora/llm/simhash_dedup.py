"""SimHash near-dedup by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments of at most 23 bits. The perfect binary Golay code
of length 23 has a codeword within three bits of every segment value, so a segment is turned into the
indices of the codewords near it. With four differing bits in all, either one segment agrees and
another differs in two bits at most, or two segments differ in one bit each and the third in one or two.
The first case is met by an exact segment with the codewords within four bits of the other (two values
two bits apart have a value midway, whose codeword is within four bits of both). In the second, the two
fingerprints have unlike parity in the first of the two segments: the even one gives its decoded codeword
there with the codewords within four bits of the second segment, the odd one those of the first with the
decoded codeword of the second. Of three parts of the third segment one agrees, and is in the key too. Fingerprints that
share a key are compared bit by bit, so nothing is linked that differs in more bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from climora.llm.components import components
from climora.llm.storage import parts_for, small_batches, stored, tidied

SHINGLE_WORDS = 4
MAX_BITS = 4
_SEED = 42
_BLOCK = 1 << 16
# Segments as (first bit, bits).
_SEGMENTS = ((0, 22), (22, 21), (43, 21))
# Parts of a segment that may differ in two bits.
_PARTS = ((0, 7), (7, 7), (14, 8))
# Generator polynomial of the binary Golay code of length 23 (fixed value).
_GENERATOR = 0b110001110101


# Fingerprints that one task turns into keys.
PRINTS_PER_TASK = 16_384


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of one text; no words give zero."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) > words:
        ends, starts = ends[words - 1 :], starts[: len(parts) - words + 1]
    else:
        ends, starts = ends[-1:], starts[:1]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _BLOCK):
        hashes = np.fromiter(
            (digest(joined[a:b], _SEED) for a, b in zip(starts[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist())),
            np.uint64,
        )
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprint_column(text: str, words: int = SHINGLE_WORDS):
    """The fingerprint as a signed long column; bytes that are no UTF-8 read as the replacement character."""

    @pandas_udf(LongType())
    def of(texts):
        import pandas as pd

        values = np.fromiter((fingerprint(t, words) for t in texts), np.uint64, len(texts))
        return pd.Series(values.view(np.int64))

    return of(F.make_valid_utf8(text))


def _syndromes(values: np.ndarray) -> np.ndarray:
    left = values.astype(np.int64)
    for bit in range(22, 10, -1):
        left = np.where(left >> bit & 1, left ^ (_GENERATOR << (bit - 11)), left)
    return left


@lru_cache(1)
def _patterns() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome, the error of three bits at most, and all errors of four bits at most (-1: none)."""
    from itertools import combinations

    by_syndrome: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        for error, syndrome in zip(errors.tolist(), _syndromes(errors).tolist()):
            by_syndrome[syndrome].append(error)
    near = np.full((2048, max(map(len, by_syndrome))), -1, np.int64)
    for row, errors in zip(near, by_syndrome):
        row[: len(errors)] = errors
    return near[:, 0], near


def golay_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys of unsigned fingerprints; two that differ in four bits at most share a key."""
    decoded, near = _patterns()
    rows = np.arange(len(values))
    segments, single, several = [], [], []
    for first, width in _SEGMENTS:
        part = (values >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64)
        syndrome = _syndromes(part)
        segments.append(part)
        single.append((part ^ decoded[syndrome]) >> 11)
        errors = near[syndrome]
        several.append(np.where(errors < 0, -1, (part[:, None] ^ errors) >> 11))
    at, keys = [], []

    def add(kind: int, base: np.ndarray, codes: np.ndarray, keep: np.ndarray) -> None:
        r, c = np.nonzero(keep)
        at.append(rows[r])
        keys.append(np.int64(kind) << 40 | base[r] | codes[r, c])

    kind = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                add(kind, segments[i] << 12, several[j], several[j] >= 0)
                kind += 1
    odd = [np.bitwise_count(part) & 1 for part in segments]
    for i, j, k in ((0, 1, 2), (0, 2, 1), (1, 2, 0)):
        of_odd = odd[i][:, None] == 1
        codes = np.where(of_odd, several[i] << 12 | single[j][:, None], single[i][:, None] << 12 | several[j])
        keep = np.where(of_odd, several[i], several[j]) >= 0
        both = (odd[i] ^ odd[j]).astype(np.int64)
        for first, width in _PARTS:
            add(kind, (both << 8 | segments[k] >> first & (1 << width) - 1) << 24, codes, keep)
            kind += 1
    return np.concatenate(at), np.concatenate(keys)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(at, 4096) for at in range(0, batch.num_rows, 4096)):
            prints = part.column("print").to_numpy(zero_copy_only=False)
            reps = part.column("rep").to_numpy(zero_copy_only=False)
            rows, keys = golay_keys(prints.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(prints[rows]), pa.array(reps[rows])], ["key", "print", "rep"]
            )


def link_components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Columns rep and component for every fingerprint that links to another.

    ``prints`` holds distinct fingerprints (print, signed long) with the smallest id that has each
    (rep). Members of a key are first compared with the key's two outermost members. Keys whose
    members are by then in one component are done; in the others, members outside the key's largest
    component are compared with all members of other components, and what they find joins whole
    components. Every pair that shares a key is so either compared or already joined, and no group is spelled out as pairs.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"keys are complete up to {MAX_BITS} bits")
    known_prints = prints.where("rep IS NOT NULL")
    dealt = known_prints.repartition(parts_for(known_prints.count(), PRINTS_PER_TASK))  # each becomes some eighty rows
    keyed = dealt.mapInArrow(tidied(_keyed), "key long, print long, rep long")
    ends = keyed.groupBy("key").agg(
        F.min(F.struct("rep", "print")).alias("low"), F.max(F.struct("rep", "print")).alias("high"),
        F.count("*").alias("members"),
    )
    # a key of two members is done when these two are compared
    ends = ends.where(f"members > 2 OR members = 2 AND bit_count(low.print ^ high.print) <= {max_bits}")
    shared = stored(keyed.join(ends, "key"), "simhash-keys")

    def near(a: str, b: str):
        return F.expr(f"bit_count({a} ^ {b}) <= {max_bits}")

    first = shared.where(near("print", "low.print")).select("rep", F.col("low.rep").alias("other")).unionByName(
        shared.where(near("print", "high.print")).select("rep", F.col("high.rep").alias("other"))
    )
    known = stored(components(first, "rep", "other"), "simhash-known")
    # a key whose members all link to its smallest is done
    far = stored(shared.where("members > 2").where(~near("print", "low.print")).select("key").distinct(), "simhash-far")
    open_keys = shared.join(far, "key", "left_semi").select("key", "print", "rep")
    labelled = stored(
        open_keys.join(known.withColumnRenamed("node", "rep"), "rep", "left")
        .select("key", "print", "rep", F.coalesce("component", "rep").alias("label")),
        "simhash-labels",
    )
    largest = stored(
        labelled.groupBy("key", "label").agg(F.count("*").alias("n"))
        .groupBy("key").agg(F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("labels"))
        .where("labels > 1").select("key", F.col("most.label").alias("main")),
        "simhash-open",
    )
    others = labelled.join(largest, "key").where("label <> main")
    left = others.select("key", F.col("print").alias("a"), F.col("rep").alias("rep_a"), F.col("label").alias("label_a"))
    second = (
        left.join(labelled, "key").where(F.col("label_a") != F.col("label")).where(near("a", "print")).select("label_a", "label")
    )
    # only components are joined from here on: what lies within them is known
    merged = stored(components(second, "label_a", "label"), "simhash-merged").select(F.col("node").alias("label"), F.col("component").alias("whole"))
    moved = known.join(merged, F.col("component") == F.col("label"), "left").select("node", F.coalesce("whole", "component").alias("component"))
    single = merged.join(known, F.col("label") == F.col("node"), "left_anti")
    return moved.unionByName(single.select(F.col("label").alias("node"), F.col("whole").alias("component")))


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, max_bits: int) -> DataFrame:
    small_batches(docs.sparkSession)
    each = stored(
        docs.select(F.col(id_col).cast("long").alias("id"), fingerprint_column(text_col, words).alias("print")),
        "simhash-prints",
    )
    prints = stored(each.groupBy("print").agg(F.min("id").alias("rep")), "simhash-distinct")
    found = link_components(prints, max_bits).withColumnRenamed("node", "rep")
    labels = stored(
        prints.join(found, "rep", "left").select("print", F.coalesce("component", "rep").alias("component_id")),
        "simhash-components",
    )
    return each.join(labels, "print")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: ``id_col``, fingerprint (16 hex digits) and component_id.

    Null and empty texts have fingerprint zero, linked like any other. Documents without an id take
    part with no id: they get the component of the documents they link to, or null. Repeated rows
    give repeated results; an empty table gives none. Other columns are not read.
    """
    return _grouped(docs, id_col, text_col, words, max_bits).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def simhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest id, once.

    Of rows that repeat an id, those in the same group leave one row. Documents without an id stay
    only where no document with an id is in their group, one row for each fingerprint.
    """
    groups = _grouped(docs, id_col, text_col, words, max_bits)
    kept = stored(
        groups.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("id", "print").agg(F.count("*").alias("n")),
        "simhash-kept",
    )
    again = stored(kept.groupBy("id").agg(F.sum("n").alias("n")).where("n > 1"), "simhash-repeated")
    key = F.col(id_col).cast("long")
    # the kept ids grow with the input: shuffled at every size
    ids = kept.select(F.col("id").alias("_climora_id")).distinct().hint("shuffle_merge")
    one = docs.join(ids, key.eqNullSafe(F.col("_climora_id")), "left_semi")
    if again.isEmpty():
        return one
    many = again.select(F.col("id").alias("_climora_id"))
    single = one.join(many, key.eqNullSafe(F.col("_climora_id")), "left_anti")
    printed = one.join(many, key.eqNullSafe(F.col("_climora_id")), "left_semi").withColumns(
        {"_climora_key": key, "_climora_print": fingerprint_column(text_col, words)}
    )
    kept = kept.select(F.col("id").alias("_climora_id"), F.col("print").alias("_climora_kept"))
    matched = (
        printed.join(
            kept,
            F.col("_climora_key").eqNullSafe(F.col("_climora_id")) & (F.col("_climora_print") == F.col("_climora_kept")),
            "left_semi",
        )
        .dropDuplicates(["_climora_key", "_climora_print"])
        .drop("_climora_key", "_climora_print")
    )
    return single.unionByName(matched)
