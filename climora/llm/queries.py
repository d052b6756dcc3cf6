"""The queries opN_<name>: each applies its operator to the whole table, with the parameters of its contract."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climora.llm import (
    embedding_dedup,
    lm_scoring,
    prefix_trie,
    quality_forest,
    sentencepiece_scan,
    simhash_dedup,
    slack_packing,
    source_mixing,
    spelling_variants,
    suffix_dedup,
    toxicity_fm,
    url_filter,
    zip_warc,
)

PIECES = os.environ.get("CLIMORA_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
WORD_TOKENS = os.environ.get("CLIMORA_WORD_TOKENS", "/opt/tokenizers/word_bpe_49k.json")
MIX_TARGET = source_mixing.Target(entropy_share=0.99, budget_share=0.75)


def _table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark, sf_dir):
    """Bytes of every document that repeat earlier strings of 100 bytes, and a digest of what stays."""
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_lm_scoring(spark, sf_dir):
    """Pseudo-likelihood of every document."""
    return lm_scoring.score_documents(_table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark, sf_dir):
    """Links and group of every vector."""
    return embedding_dedup.embedding_groups(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op4_url_filter(spark, sf_dir):
    """Rule and verdict of every page; outcomes are pages marked by their own text or by their host's name."""
    pages = _table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, url_filter.outcomes_of_pages(pages))


def op5_simhash_dedup(spark, sf_dir):
    """Fingerprint and group of every document."""
    return simhash_dedup.simhash_groups(_table(spark, sf_dir, "documents"), words=4, max_bits=4)


def op6_zip_warc(spark, sf_dir):
    """Every page as a record, read back from its package."""
    read = zip_warc.packed_and_read(_table(spark, sf_dir, "pages"), least_bytes=0)
    return read.select(
        zip_warc.page_column("record_id").alias("page_id"), F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"), zip_warc.page_column("refers_to").alias("refers_to"),
    )


def op7_source_mixing(spark, sf_dir):
    """How often every document is in a mixture of 99 % of the largest entropy and 75 % of all words."""
    return source_mixing.mix(_table(spark, sf_dir, "documents"), target=MIX_TARGET)


def op8_quality_forest(spark, sf_dir):
    """Rule counts and verdict of every document."""
    judged = quality_forest.judge_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"
    )


def op9_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    return toxicity_fm.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.7)


def op10_sentencepiece(spark, sf_dir):
    """Piece ids of every document, and whether they decode to its text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = sentencepiece_scan.encode(docs, PIECES)
    text = F.replace(F.coalesce("text", F.lit("")), F.lit("▁"), F.lit(" "))  # the sign itself decodes to a space
    return sentencepiece_scan.decode(encoded, PIECES).select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", (F.col("decoded") == text).alias("round_trip")
    )


def op11_spelling_variants(spark, sf_dir):
    """Words of all documents and the frequent spellings that they are variants of."""
    return spelling_variants.spelling_groups(_table(spark, sf_dir, "documents"), shortest=5, least=3, factor=2, every=97)


def op12_prefix_trie(spark, sf_dir):
    """Nodes of the trie of all conversations, each begun with the first turns of its family's first."""
    return prefix_trie.family_trie(_table(spark, sf_dir, "conversations"), family=100, most=5)


def op13_slack_packing(spark, sf_dir):
    """Pieces of all documents in sequences of 4,096 ids."""
    pieces = slack_packing.pack_documents(_table(spark, sf_dir, "documents"), WORD_TOKENS, capacity=4096, end_id=2)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def pipeline(spark, sf_dir):
    """The stages of corpus_pipeline.py over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_suffix_dedup": (op1_suffix_dedup, None),
    "op2_lm_scoring": (op2_lm_scoring, None),
    "op3_embedding_dedup": (op3_embedding_dedup, None),
    "op4_url_filter": (op4_url_filter, url_filter.judge_sql()),
    "op5_simhash_dedup": (op5_simhash_dedup, None),
    "op6_zip_warc": (op6_zip_warc, None),
    "op7_source_mixing": (op7_source_mixing, source_mixing.mix_sql(MIX_TARGET.entropy_share, MIX_TARGET.budget_share)),
    "op8_quality_forest": (op8_quality_forest, None),
    "op9_toxicity": (op9_toxicity, None),
    "op10_sentencepiece": (op10_sentencepiece, None),
    "op11_spelling_variants": (op11_spelling_variants, spelling_variants.spelling_sql(shortest=5, least=3, factor=2, every=97)),
    "op12_prefix_trie": (op12_prefix_trie, prefix_trie.trie_sql(family=100, most=5)),
    "op13_slack_packing": (op13_slack_packing, None),
    "pipeline": (pipeline, None),
}
