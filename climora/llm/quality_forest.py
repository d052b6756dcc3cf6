"""Quality rules by an isolation forest on statistics of the text.

Counts of words, symbols, repeated lines and so on give shares that do not depend on a text's length. Trees cut these
shares at random; a text that is unlike most is alone after few cuts. As in any isolation forest a tree is grown on a few hundred rows
of its own; it draws them from all labelled rows. The score from which on a text is rejected is calibrated on all labelled rows:
that with the best trade of bad texts found against good ones lost, among those that lose few good ones.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType, StructField, StructType

from climora.llm.storage import dropped, parts_for, small_batches, stored

TREES, TREE_ROWS = 200, 256
#: Rows that are sent to a tree, as a multiple of those it takes: chance leaves it short once in far more than a lifetime.
SPARE = 4
#: Different scores of a stretch that the calibration sums up in one go.
LEVELS = 512
MOST_LOST = 0.005
#: Words of ordinary text that are added to each text, so that chance alone makes no short text unusual.
PRIOR_WORDS = 50
#: Bad rows are made this share of what the trees are grown on, so that they are the unusual ones.
BAD_SHARE = 0.02
_SYMBOLS = b"#*$%&|<>"
_WINDOW = 5
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits", "n_points",
)
_SCHEMA = StructType([StructField(c, LongType()) for c in COUNTS])


def counts(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``; words are runs of anything but ASCII white space."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    word_bytes = sum(map(len, words))
    seen: set[bytes] = set()
    lines = repeated_lines = 0
    for line in data.split(b"\n"):
        if line and line.split(None, 1):
            lines += 1
            if line in seen:
                repeated_lines += 1
            else:
                seen.add(line)
    repeated = 0
    if len(words) > _WINDOW:
        windows = list(zip(*(words[k:] for k in range(_WINDOW))))
        met = Counter(windows)
        if len(met) < len(windows):
            upto = 0
            for at, window in enumerate(windows):
                if met[window] > 1:
                    repeated += at + _WINDOW - max(upto, at)
                    upto = at + _WINDOW
    codes = np.bincount(np.frombuffer(data, np.uint8), minlength=128)
    return (
        len(words), len(text) - (len(data) - word_bytes), int(sum(codes[c] for c in _SYMBOLS)), repeated_lines, repeated,
        lines, len(set(words)), int(codes[65:91].sum()), int(codes[48:58].sum()), int(sum(codes[c] for c in b".,;:!?")),
    )


@pandas_udf(_SCHEMA)
def _counts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([counts(t) for t in texts], columns=list(COUNTS), dtype="int64")


def features(table: np.ndarray) -> np.ndarray:
    """Shares from rows of counts; repeats are left to the base rules, since clean texts have them too."""
    words, chars, symbols, _, _, _, distinct, upper, _, points = table.T.astype(float)
    w, c = words + PRIOR_WORDS, chars + 5 * PRIOR_WORDS
    rest = c - symbols
    return np.stack(
        [rest / w, symbols / c, (upper + 0.15 * PRIOR_WORDS) / rest, (points + 0.15 * PRIOR_WORDS) / w, np.maximum(0.5 - (distinct + 0.7 * PRIOR_WORDS) / w, 0)],
        axis=1,
    )


def place_of(hashes: np.ndarray, tree: np.ndarray) -> np.ndarray:
    """Places of rows in the order that a tree draws them, unsigned 64 bits; rows of different hashes have different ones."""
    x = hashes.astype(np.uint64) ^ (tree.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _expected(n: np.ndarray) -> np.ndarray:
    """Mean depth of a search in a random tree of n leaves."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Trees as arrays, one row each: feature (-1: leaf), cut, left child (right: one more), depth with what a leaf adds."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    depth: np.ndarray
    rows: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly of each row, 0 to 1."""
        total = np.zeros(len(x))
        row = np.arange(len(x))
        for feature, cut, child, depth in zip(self.feature, self.cut, self.child, self.depth):
            at = np.zeros(len(x), np.int64)
            open_ = row
            while len(open_):
                open_ = open_[feature[at[open_]] >= 0]
                here = at[open_]
                at[open_] = child[here] + (x[open_, feature[here]] >= cut[here])
            total += depth[at]
        return 2.0 ** (-total / len(self.feature) / max(float(_expected(self.rows)), 1e-9))


def _tree(rows: np.ndarray, most: int, rng: np.random.Generator) -> tuple[list, list, list, list]:
    """feature, cut, child and depth of one tree, cut at random until rows are alone or ``most`` deep."""
    feature, cut, child, depth = [-1], [0.0], [0], [0.0]
    todo = [(0, rows, 0)]
    while todo:
        node, part, level = todo.pop()
        if not len(part):
            depth[node] = float(level)
            continue
        low, high = part.min(axis=0), part.max(axis=0)
        open_ = np.nonzero(high > low)[0]
        if level >= most or len(part) < 2 or not len(open_):
            depth[node] = level + float(_expected(len(part)))
            continue
        f = int(rng.choice(open_))
        at = float(rng.uniform(low[f], high[f]))
        right = part[:, f] >= at
        feature[node], cut[node], child[node] = f, at, len(feature)
        for side, rest in ((len(feature), part[~right]), (len(feature) + 1, part[right])):
            todo.append((side, rest, level + 1))
        feature += [-1, -1]
        cut += [0.0, 0.0]
        child += [0, 0]
        depth += [0.0, 0.0]
    return feature, cut, child, depth


def _most(rows: int) -> int:
    return int(np.ceil(np.log2(max(rows, 2))))


def _forest(made: list[tuple], rows: int) -> Forest:
    size = max(len(m[0]) for m in made)
    kinds = (np.int64, np.float64, np.int64, np.float64)
    arrays = [np.array([list(m[k]) + [-1 if k == 0 else 0] * (size - len(m[k])) for m in made], kind) for k, kind in enumerate(kinds)]
    return Forest(*arrays, rows)


def fit_forest(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 11) -> Forest:
    """Trees over samples of ``rows`` rows, cut at random until alone or too deep."""
    rng = np.random.default_rng(seed)
    rows = min(rows, len(x))
    return _forest([_tree(x[rng.choice(len(x), rows, replace=False)], _most(rows), rng) for _ in range(trees)], rows)


def drawn(known: DataFrame, trees: int, rows: int) -> tuple[DataFrame, int]:
    """Columns tree, place and counts of the rows that trees may take, a few times ``rows`` for each, and how many it takes.

    ``known`` has place (a hash of the id), good and the counts. Every good row stands in the order of every tree, and of the bad ones a share of
    their own in each, so that they are about ``BAD_SHARE`` of the good ones; without good rows all bad ones do. A tree takes the first.
    """
    good, bad = known.agg(F.count_if("good"), F.count_if(~F.col("good"))).first()
    few = min(bad, max(1, int(good * BAD_SHARE))) if good else bad
    takes = min(rows, good + few)
    let_in = np.uint64(min(1.0, few / max(bad, 1)) * (2**64 - 2**11))
    until = np.uint64(min(1.0, SPARE * takes / max(good + few, 1)) * (2**64 - 2**11))

    def drawing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_tree = np.arange(trees)[:, None]
        for batch in batches:
            hashes = batch.column("place").to_numpy().view(np.uint64)[None, :]
            fine = batch.column("good").to_numpy(zero_copy_only=False)[None, :]
            places = place_of(hashes, of_tree)
            tree, row = np.nonzero((places <= until) & (fine | (place_of(hashes, of_tree + trees) <= let_in) | (few == bad)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree.astype(np.int32)), pa.array((places[tree, row] >> np.uint64(1)).astype(np.int64)),
                 *(batch.column(c).take(pa.array(row)) for c in COUNTS)],
                ["tree", "place", *COUNTS],
            )

    counted = ", ".join(f"{c} long" for c in COUNTS)
    return known.select("place", "good", *COUNTS).mapInArrow(drawing, f"tree int, place long, {counted}"), takes


def grown(known: DataFrame, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 11) -> Forest | None:
    """A forest over labelled rows, each tree grown by the task that its rows are sent to; None without rows."""
    sent, takes = drawn(known, trees, rows)
    if not takes:
        return None

    def grow(key: tuple[Any, ...], part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["place", *COUNTS]).head(takes)
        tree = int(key[0])
        made = _tree(features(part[list(COUNTS)].to_numpy(np.int64)), _most(takes), np.random.default_rng([seed, tree]))
        return pd.DataFrame({"tree": [tree], **{n: [m] for n, m in zip(("feature", "cut", "child", "depth"), made)}})

    made = sent.groupBy("tree").applyInPandas(
        grow, "tree int, feature array<int>, cut array<double>, child array<int>, depth array<double>"
    ).collect()  # nodes of ``trees`` trees, each of at most twice ``rows``
    return _forest([tuple(r)[1:] for r in sorted(made, key=lambda r: r.tree)], takes)


def calibrated(scores: np.ndarray, good: np.ndarray, most_lost: float = MOST_LOST) -> float:
    """The score from which on texts are rejected: at most ``most_lost`` of the good ones, and else the best trade.

    ``threshold`` gives the same for a DataFrame.
    """
    if not good.any() or good.all():
        return 2.0  # nothing is rejected
    order = np.argsort(-scores, kind="stable")
    found = np.cumsum(~good[order]) / (~good).sum()
    lost = np.cumsum(good[order]) / good.sum()
    last = np.concatenate((scores[order][1:] != scores[order][:-1], [True]))  # ties go together
    trade = np.where(last & (lost <= most_lost), found - lost, -1.0)
    best = int(trade.argmax())
    return float(scores[order][best]) if trade[best] > 0 else 2.0


def threshold(scored: DataFrame, most_lost: float = MOST_LOST) -> float:
    """The score from which on texts are rejected, of all rows of ``scored`` (anomaly, good).

    Different scores are dealt to stretches of about ``LEVELS``; those are summed up first, and then the scores in each.
    """
    levels = stored(
        scored.groupBy("anomaly").agg(F.count_if("good").alias("fine"), F.count_if(~F.col("good")).alias("bad")), "quality-levels"
    )
    many, fine, bad = levels.agg(F.count("*"), F.sum("fine"), F.sum("bad")).first()
    if not fine or not bad:
        return 2.0  # nothing is rejected
    parts = parts_for(many, LEVELS)
    cuts = levels.approxQuantile("anomaly", [k / parts for k in range(1, parts)], 0.25 / parts) if parts > 1 else []
    cuts = np.unique(cuts)

    @pandas_udf("int")
    def stretch(scores: pd.Series) -> pd.Series:
        return pd.Series(len(cuts) - np.searchsorted(cuts, scores.to_numpy(), "right"), dtype="int32")

    dealt = levels.withColumn("part", stretch("anomaly"))
    sums = sorted(dealt.groupBy("part").agg(F.sum("fine"), F.sum("bad")).collect())  # a row per stretch
    before, so_far = [], (0, 0)
    for part, *more in sums:
        before.append((part, *so_far))
        so_far = tuple(a + b for a, b in zip(so_far, more))
    earlier = levels.sparkSession.createDataFrame(before, "part int, fine_before long, bad_before long")
    upto = Window.partitionBy("part").orderBy(F.desc("anomaly")).rowsBetween(Window.unboundedPreceding, 0)
    found = (F.col("bad_before") + F.sum("bad").over(upto)) / F.lit(bad)
    lost = (F.col("fine_before") + F.sum("fine").over(upto)) / F.lit(fine)
    best = (
        dealt.join(F.broadcast(earlier), "part").select("anomaly", found.alias("found"), lost.alias("lost"))
        .where(F.col("lost") <= F.lit(float(most_lost)))
        .agg(F.max(F.struct((F.col("found") - F.col("lost")).alias("trade"), "anomaly"))).first()[0]
    )
    return float(best.anomaly) if best is not None and best.trade > 0 else 2.0


def base_failed():
    """Too few words, or over a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _of_labels(rows: DataFrame, id_col: str, marked: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``columns`` of labelled ids that pass the base rules, with _climora_id and good; of several texts of an id that with the smallest hash."""
    return (
        rows.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_climora_id"))
        .agg(F.min(F.struct("_climora_hash", *columns)).alias("_climora_row")).join(marked, "_climora_id")
        .select("_climora_id", (F.col("_climora_label") == 1).alias("good"), *[F.col(f"_climora_row.{c}") for c in columns])
        .where(~base_failed())
    )


def judge_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_lost: float = MOST_LOST,
) -> DataFrame:
    """One row per document: ``id_col``, the counts, base_failed, anomaly (score) and kept.

    The forest and its threshold come from all labelled rows; of several labels of an
    id the smallest counts, null labels none, and of several texts of an id that with the smallest hash. Without labels of both kinds only the base rules reject. Null texts are empty, bytes that are no UTF-8 read as the replacement character,
    repeated rows give repeated results, an empty table none; other columns are not read.
    """
    small_batches(docs.sparkSession)
    text = F.make_valid_utf8(text_col)
    counted = stored(
        docs.select(F.col(id_col), F.xxhash64(text).alias("_climora_hash"), _counts(text).alias("c")).select(F.col(id_col), "_climora_hash", "c.*"),
        "quality-counts",
    )
    marked = stored(
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("_climora_id")).agg(F.min(F.col(label_col).cast("int")).alias("_climora_label")),
        "quality-labels",
    )
    known = stored(_of_labels(counted, id_col, marked, COUNTS).withColumn("place", F.xxhash64("_climora_id")), "quality-known")
    forest = grown(known)
    dropped(known)

    @pandas_udf("double")
    def anomaly(c: pd.DataFrame) -> pd.Series:
        if forest is None:
            return pd.Series(np.zeros(len(c)))
        return pd.Series(forest.scores(features(c[list(COUNTS)].to_numpy(np.int64))))

    scored = stored(counted.withColumn("anomaly", anomaly(F.struct(*COUNTS))), "quality-scores")
    dropped(counted)
    limit = threshold(_of_labels(scored, id_col, marked, (*COUNTS, "anomaly")), most_lost)
    judged = scored.drop("_climora_hash").withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < F.lit(limit)))
