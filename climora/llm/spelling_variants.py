"""Spelling variants: words one edit apart, found by words over a reduced alphabet.

Letters are hashed to a few symbols, which turns words into reduced words; words one edit apart have reduced words that
are equal or one edit apart. The whole one-edit neighbourhood of each reduced word is generated over the few symbols and
joined with the reduced words that exist, and the words behind both are verified by their letters. Each pair of reduced words
is generated from one of its two sides: a replaced symbol from the smaller symbol, an inserted one as the deletion from the longer
word. Reduced words are 64-bit polynomials over their symbols, so that a neighbour is one multiplication away, also in a word of
any length; should two share a number, verification drops what they bring together.

A reduced word may stand for many words, whose pairs would grow with the square of their number. Words of such crowded
classes are joined by their own neighbourhoods instead, over all letters: these meet nothing but words one edit apart.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climora.llm.checksum_sql import crc32_sql
from climora.llm.storage import dropped, parts_for, small_batches, stored

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LETTERS = [*map(chr, range(ord("a"), ord("z") + 1)), *map(chr, range(0xC0, 0x100))]
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
SYMBOLS = 12
# Words that share a reduced word before they count as crowded.
CROWDED = 64
# Reduced words that one task makes the neighbours of.
WORDS_PER_TASK = 16_384
# Runs and distinct words that a task counts before it hands them on; neighbours made at once.
_RUNS = 200_000
_HELD = 200_000
_CELLS = 500_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def word_counts(docs: DataFrame, every: int = 97) -> DataFrame:
    """Columns word and n: the words of all texts, after a change to one in ``every`` runs of a document.

    A run is a longest sequence of the letters A-Z, a-z and U+00C0 to U+00FF, of which A-Z are lower-cased. Where ``every`` divides the
    unsigned CRC-32 h of ``<doc_id>:<run>``, the run loses the code point at h % length. A null text has no words, a null doc_id
    counts as the empty string, and bytes that are no UTF-8 as the replacement character.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out():
            made = pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return made

        for batch in batches:
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"].to_pylist()):
                start = zlib.crc32(f"{doc}:".encode())
                runs = map(re.Match.group, _RUN.finditer(text)) if len(text) > _RUNS else iter(_RUN.findall(text))
                while some := Counter(islice(runs, _RUNS)):
                    for own, many in some.items():
                        word = own.lower() if own.isascii() else own.translate(_LOWER)
                        h = zlib.crc32(word.encode(), start)
                        if h % every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                        held[word] += many
                    if len(held) >= _HELD:
                        yield out()
        if held:
            yield out()

    plain = docs.where("text IS NOT NULL").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.make_valid_utf8("text").alias("text")
    )
    return plain.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class _Alphabet:
    """Numbers of reduced words, and of all words one edit away."""

    def __init__(self, symbols: int | None):
        codes = {c: 1 + (k if symbols is None else zlib.crc32(c.encode()) % symbols) for k, c in enumerate(_LETTERS)}
        self.size = len(_LETTERS) if symbols is None else symbols
        self.code = np.zeros(256, np.uint64)
        self.code[[ord(c) for c in codes]] = list(codes.values())

    def read(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words of one length, a row each, and their powers."""
        length = len(words[0])
        symbols = self.code[np.frombuffer("".join(words).encode("latin-1"), np.uint8)].reshape(len(words), length)
        powers = np.cumprod(np.full(length + 1, _BASE, np.uint64))
        return symbols, powers

    def numbers(self, words: list[str]) -> np.ndarray:
        """Number of each reduced word."""
        out = np.zeros(len(words), np.uint64)
        for at in _by_length(words):
            symbols, powers = self.read([words[i] for i in at])
            out[at] = (symbols * powers[:-1]).sum(axis=1, dtype=np.uint64)
        return out.view(np.int64)

    def neighbours(self, words: list[str], whole: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places in ``words`` and the numbers one edit from their reduced words, these included; bounded parts.

        ``whole`` gives the neighbourhood to all sides. Else the side of a pair is chosen as the module says.
        """
        for at in _by_length(words):
            symbols, powers = self.read([words[i] for i in at])
            terms = symbols * powers[:-1]
            total = terms.sum(axis=1, dtype=np.uint64)
            yield at, total.view(np.int64)
            before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
            after = total[:, None] - before - terms
            same = np.zeros(symbols.shape, bool)  # deleting the second of two equal symbols gives the same word
            same[:, 1:] = symbols[:, 1:] == symbols[:, :-1]
            shorter = before + after * _BACK
            yield at[np.nonzero(~same)[0]], shorter[~same].view(np.int64)
            for symbol in range(1, self.size + 1):
                sign = np.uint64(symbol)
                fits = symbols != sign if whole else symbols < sign
                other = total[:, None] + (sign - symbols) * powers[:-1]
                yield at[np.nonzero(fits)[0]], other[fits].view(np.int64)
                if whole:
                    fits = symbols != sign  # behind the same symbol it is the insertion before it
                    longer = before + sign * powers[:-1] + (after + terms) * _BASE
                    yield at[np.nonzero(fits)[0]], longer[fits].view(np.int64)
                    yield at, (total + powers[-1:] * sign).view(np.int64)


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    """Places of words of one length, so many that their symbols fit into a bounded table."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for part in np.split(order, np.nonzero(np.diff(lengths[order]))[0] + 1):
        if len(part):
            step = max(1, _CELLS // max(1, int(lengths[part[0]])))
            for k in range(0, len(part), step):
                yield part[k : k + step]


def _with_numbers(words: DataFrame, symbols: int | None) -> DataFrame:
    """Adds ``key``, the number of the reduced word."""

    def run(batches):
        alphabet = _Alphabet(symbols)
        for batch in batches:
            yield batch.append_column("key", pa.array(alphabet.numbers(batch["word"].to_pylist())))

    return words.mapInArrow(run, "word string, n bigint, key bigint")


def _near_numbers(words: DataFrame, symbols: int | None, whole: bool, name: str) -> DataFrame:
    """Rows (``name``, other): the column as it is, and each number one edit away from its ``word``."""

    def run(batches):
        alphabet = _Alphabet(symbols)
        for batch in batches:
            own = batch[name]
            for at, numbers in alphabet.neighbours(batch["word"].to_pylist(), whole):
                yield pa.RecordBatch.from_arrays([own.take(pa.array(at)), pa.array(numbers)], names=[name, "other"])

    columns = [name] if name == "word" else [name, "word"]
    kind = words.schema[name].dataType.simpleString()
    return words.select(*columns).mapInArrow(run, f"{name} {kind}, other bigint")


def near_pairs(words: DataFrame, symbols: int = SYMBOLS, crowded: int = CROWDED) -> DataFrame:
    """Columns word, n, other, other_n: every word with every other one exactly one inserted, deleted or replaced code point away.

    ``words`` holds distinct words of the letters above with their counts.
    """
    numbered = stored(_with_numbers(words.select("word", "n"), symbols), "spelling-numbers")
    classes = stored(numbered.groupBy("key").agg(F.min("word").alias("word"), F.count("*").alias("size")), "spelling-classes")
    calm = classes.where(F.col("size") <= crowded)
    apart = F.levenshtein("word", "other_word", 1) == 1
    members = numbered.join(calm.select("key"), "key", "left_semi")
    met = (
        _near_numbers(calm.repartition(parts_for(calm.count(), WORDS_PER_TASK)), symbols, False, "key")  # some sixty rows each
        .join(members.select(F.col("key").alias("other"), F.col("word").alias("other_word"), F.col("n").alias("other_n")), "other")
    )
    found = (
        members.join(met, "key")
        .where((F.col("key") != F.col("other")) | (F.col("word") < F.col("other_word")))
        .where(apart).select("word", "n", F.col("other_word").alias("other"), "other_n")
    )
    dense = numbered.join(classes.where(F.col("size") > crowded).select("key"), "key", "left_semi").select("word", "n")
    dense = dense.repartition(parts_for(dense.count(), WORDS_PER_TASK // 32))
    exact = _with_numbers(words.select("word", "n"), None).select(F.col("key").alias("other"), F.col("word").alias("other_word"), F.col("n").alias("other_n"))
    close = _near_numbers(dense, None, True, "word").join(exact, "other").where(apart).select("word", "other_word", "other_n").join(dense, "word")
    # Both members of a pair may be crowded and find each other: the two directions then meet below.
    one_way = found.unionByName(close.select("word", "n", F.col("other_word").alias("other"), "other_n"))
    table = stored(one_way, "spelling-pairs")
    both = table.unionByName(table.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return both.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """Columns word and root, from rows (word, form): forms are followed to the last by doubling the steps.

    A form is at least twice as frequent as its word, so a path has fewer steps than a count has bits.
    """
    steps = stored(forms.select("word", F.col("form").alias("root")), "spelling-steps")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("then"))
        moved = stored(steps.join(ahead, "root", "left").select("word", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")), "spelling-steps")
        dropped(steps)
        steps = moved
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")


def spelling_groups(docs: DataFrame, shortest: int = 5, least: int = 3, factor: int = 2, every: int = 97) -> DataFrame:
    """Columns word, form, root, n, n_near, form_n: each word of the documents and the spelling that it is a variant of.

    Words (see ``word_counts``) have at least ``shortest`` code points and ``least`` occurrences. Words are near when one code point
    is inserted, deleted or replaced. A word's form is its most frequent near word (the smallest in code-point order among
    equals) if that is at least ``factor`` (2 or more) times as frequent; root is the end of the path of forms, or the word itself.

    Repeated rows count as often as they stand there. No rows, and texts without letters, give no words. Other columns are left out.
    """
    if factor < 2:
        raise ValueError("with a factor below 2 words could be forms of each other")
    small_batches(docs.sparkSession)
    words = stored(
        word_counts(docs, every).where((F.length("word") >= shortest) & (F.col("n") >= least)), "spelling-words"
    )
    best = near_pairs(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best")
    )
    enough = -F.col("best.less") >= F.lit(factor) * F.col("n")
    judged = stored(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_sql(shortest: int = 5, least: int = 3, factor: int = 2, every: int = 97) -> str:
    """``spelling_groups`` in SQL: near words agree when a letter is left out of one, or of both at the same place."""
    big, small = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
    return f"""
    WITH RECURSIVE runs AS (
        SELECT doc_id, translate(r, '{big}', '{small}') AS r, count(*) AS many
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM documents) GROUP BY ALL
    ),
    hashed AS (SELECT r, many, {crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r")} AS h FROM runs),
    w AS (
        SELECT word, CAST(sum(many) AS BIGINT) AS n FROM (
            SELECT many, CASE WHEN h % {every} = 0 THEN substr(r, 1, h % length(r)) || substr(r, CAST(h % length(r) AS BIGINT) + 2) ELSE r END AS word
            FROM hashed
        ) GROUP BY word HAVING length(word) >= {shortest} AND sum(many) >= {least}
    ),
    cut AS (
        SELECT word, n, k, length(word) AS long, substr(word, 1, k) || substr(word, k + 2) AS rest
        FROM (SELECT word, n, unnest(range(length(word))) AS k FROM w)
    ),
    near AS (
        SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.k = b.k AND a.long = b.long AND a.word <> b.word
        UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN w b ON a.rest = b.word
        UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN w b ON a.rest = b.word
    ),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM near),
    judged AS (
        SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.other_n >= {factor} * w.n THEN r.other END AS form,
            CASE WHEN r.other_n >= {factor} * w.n THEN r.other_n END AS form_n
        FROM w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1
    ),
    path AS (
        SELECT word, form AS root FROM judged WHERE form IS NOT NULL
        UNION ALL SELECT p.word, j.form FROM path p JOIN judged j ON j.word = p.root WHERE j.form IS NOT NULL
    ),
    ends AS (SELECT p.word, p.root FROM path p JOIN judged j ON j.word = p.root AND j.form IS NULL)
    SELECT j.word, j.form, coalesce(e.root, j.word) AS root, j.n, j.n_near, j.form_n FROM judged j LEFT JOIN ends e ON e.word = j.word
    """
