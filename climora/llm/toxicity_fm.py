"""Toxicity by a factorization machine over hashed terms.

A document is the set of its lower-cased words, hashed to buckets. Buckets are screened by their
chi-square with the label, counted by Spark over the labelled rows; the machine learns a weight for
each bucket that is left and a short vector whose products score pairs of buckets, so that two terms
which are harmless alone can be toxic together.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from climora.llm.storage import one_text_per_id, small_batches, stored

BUCKETS = 1 << 20
#: Bound on the labelled rows that the machine is fitted on, as the fit runs on the driver.
MAX_ROWS = 20_000
FEATURES = 1024
FACTORS = 8
THRESHOLD = 0.7
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Machine:
    """A fitted machine: ``buckets`` sorted; ``weights`` per bucket; ``factors`` per bucket and factor."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def logit(self, places: np.ndarray) -> float:
        """Raw score of a document that holds the buckets at ``places``."""
        v = self.factors[places]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        return self.bias + float(self.weights[places].sum()) + pairs

    def places(self, buckets: np.ndarray) -> np.ndarray:
        """Where the known ones of ``buckets`` stand in the machine's list."""
        if not len(self.buckets):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.buckets, buckets), len(self.buckets) - 1)
        return np.unique(at[self.buckets[at] == buckets])

    def score(self, text: str | None) -> float:
        """Probability of the label 1."""
        z = self.logit(self.places(hashed_terms(text)))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def hashed_terms(text: str | None) -> np.ndarray:
    """Distinct buckets of the words of a text, sorted."""
    crc, mask = zlib.crc32, BUCKETS - 1
    words = set(_WORD.findall((text or "").lower()))
    return np.unique(np.fromiter((crc(w.encode("utf-8", "surrogatepass")) & mask for w in words), np.int64, len(words)))


@pandas_udf(ArrayType(IntegerType()))
def _terms(texts):
    import pandas as pd

    return pd.Series([hashed_terms(t).astype(np.int32) for t in texts])


def fit_matrix(x: np.ndarray, y: np.ndarray, factors: int = FACTORS, epochs: int = 30, l2: float = 1e-4, seed: int = 7):
    """Bias, weights and factors by Adam on the logistic loss; ``x`` is 0/1, rows in any order."""
    rng = np.random.default_rng(seed)
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    params = [np.array([np.log(rate / (1 - rate))]), np.zeros(x.shape[1]), rng.normal(0, 0.05, (x.shape[1], factors))]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), 256):
            rows = order[at : at + 256]
            xb = x[rows].astype(np.float64)
            xv = xb @ params[2]
            z = params[0] + xb @ params[1] + 0.5 * (xv**2 - xb @ params[2] ** 2).sum(axis=1)
            off = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y[rows]) / len(rows)
            gradients = [
                np.array([off.sum()]),
                xb.T @ off + l2 * params[1],
                xb.T @ (off[:, None] * xv) - params[2] * (xb.T @ off)[:, None] + l2 * params[2],
            ]
            step += 1
            for p, g, m, s in zip(params, gradients, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return float(params[0][0]), params[1], params[2]


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_rows: int = MAX_ROWS, features: int = FEATURES, factors: int = FACTORS,
) -> Machine:
    """A machine fitted on the labelled documents, ``max_rows`` of them at most, chosen by a hash of the id.

    Ids with several labels count as 1 if any is, of several texts of an id that with the smallest hash counts; labels that are null, or without a document, are left
    out. Without labelled rows the machine scores one half. At most ``features`` buckets, those of the
    largest chi-square that three documents hold, enter the machine.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sample = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("_climora_id")).agg(F.max(F.col(label_col).cast("int")).alias("_climora_label"))
        .orderBy(F.xxhash64("_climora_id"), "_climora_id").limit(max_rows)
    )
    chosen = F.broadcast(stored(sample, "toxicity-sample"))  # max_rows pairs of numbers at most
    terms = stored(
        one_text_per_id(docs, id_col, text_col).join(chosen, "_climora_id")
        .groupBy("_climora_id", "_climora_label").agg(F.min_by("text", "_climora_hash").alias("text"))
        .select(F.col("_climora_label").alias("label"), _terms("text").alias("terms")),
        "toxicity-terms",
    )
    totals = terms.agg(F.count("*"), F.sum("label")).first()
    n, ones = totals[0], totals[1] or 0
    if not n:
        return Machine(0.0, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, factors)))
    counts = terms.select("label", F.explode("terms").alias("bucket")).groupBy("bucket").agg(
        F.count("*").alias("df"), F.sum("label").cast("double").alias("hits")
    )
    expected = F.col("df") * F.lit(ones / n)
    variance = expected * F.lit(1 - ones / n) * (F.lit(float(n)) - F.col("df") + 1) / F.lit(float(n))
    top = (
        counts.where("df >= 3").select("bucket", ((F.col("hits") - expected) * (F.col("hits") - expected) / (variance + F.lit(1e-9))).alias("chi"))
        .orderBy(F.desc("chi"), "bucket").limit(features).collect()
    )
    buckets = np.array(sorted(r.bucket for r in top), np.int64)
    known = F.split(F.lit(",".join(map(str, buckets))), ",").cast("array<int>")
    rows = sorted(  # max_rows rows of features numbers at most
        (list(r.terms), r.label) for r in terms.select("label", F.array_intersect("terms", known).alias("terms")).collect()
    ) if len(buckets) else []
    x = np.zeros((len(rows), len(buckets)), np.float32)
    for at, (held, _) in enumerate(rows):
        x[at, np.searchsorted(buckets, np.array(held, np.int64))] = 1
    if not len(buckets):  # no term is in three documents
        return Machine(float(np.log((ones + 0.5) / (n - ones + 0.5))), buckets, np.zeros(0), np.zeros((0, factors)))
    bias, weights, vectors = fit_matrix(x, np.array([label for _, label in rows], float), factors)
    return Machine(bias, buckets, weights, vectors)


def score_column(text_col: str, machine: Machine):
    """The score of a text column, 0 to 1; null and empty texts have that of no terms, and bytes that are no UTF-8 read as the replacement character."""

    @pandas_udf(DoubleType())
    def score(texts):
        import pandas as pd

        return pd.Series([machine.score(t) for t in texts], dtype=float)

    return score(F.make_valid_utf8(text_col))


def held_out(id_col: str):
    """Whether a row's label is kept out of the fit: CRC-32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document: ``id_col``, held_out, score and predicted (1 at ``threshold`` and above).

    The fit reads labels only of ids that are not held out. Repeated rows give repeated results; an
    empty table gives none; other columns are not read.
    """
    machine = fit_toxicity(docs, labels.where(~held_out(id_col)), id_col, text_col, label_col)
    return docs.select(
        F.col(id_col), held_out(id_col).alias("held_out"), score_column(text_col, machine).alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more; columns as they were."""
    machine = fit_toxicity(docs, labels.where(~held_out(id_col)), id_col, text_col, label_col)
    return docs.where(score_column(text_col, machine) < threshold)
