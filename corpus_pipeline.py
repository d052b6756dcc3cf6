"""A corpus pipeline of five stages, each written as Parquet in the shared folder and reread.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last keep the columns of
``documents``. Rows with null texts, empty texts or null sources pass as the operators define it; an
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climora.llm import sentencepiece_scan, simhash_dedup, source_mixing, suffix_dedup, toxicity_fm
from climora.llm.queries import PIECES
from climora.llm.storage import stored

MIX_TARGET = source_mixing.Target(max_repeat=1.25, budget_share=None)


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity_fm.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.7)


def drop_near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash_dedup.simhash_dedup(docs, words=4, max_bits=4)


def cut_repeats(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that start earlier are cut out; documents of which nothing is left go.

    Bytes of a character that was cut in two are left out. n_chars is counted anew where bytes were removed.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = F.struct(*[F.col(f"`{c}`") for c in others], F.col("text").isNull().alias("_climora_null"))
    left = suffix_dedup.remove_repeats(docs.select("doc_id", "text", row.alias("_row")), length=100, carry=("_row",), as_text=True)
    text = F.when(F.col("_row._climora_null"), F.lit(None)).otherwise(F.col("kept"))
    size = F.when(F.col("n_removed") == 0, F.col("_row.n_chars")).otherwise(F.char_length(text).cast("long")) if "n_chars" in others else None
    columns = {"doc_id": F.col("doc_id"), "text": text, "n_chars": size}
    return left.where("n_removed = 0 OR n_removed < n_bytes").select(
        *[columns.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns]
    )


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated up to 1.25 times; every document stays once at least."""
    return source_mixing.mixed_documents(docs, target=MIX_TARGET)


def to_pieces(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, piece ids and their number; the text is what the ids decode to."""
    encoded = sentencepiece_scan.encode(docs.select("doc_id", "source", "text"), PIECES)
    return encoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("source_mixing", mix_sources),
    ("sentencepiece", to_pieces),
]

# Models and fingerprints of the stages cannot be told in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
