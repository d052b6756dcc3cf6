"""Texts whose bytes are no UTF-8, and ids that stand in very many rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from climora.llm import (
    lm_scoring, quality_forest, sentencepiece_scan, simhash_dedup, storage, suffix_dedup, toxicity_fm, zip_warc,
)
from climora.llm.queries import PIECES

BAD = b"some words \xff\xfe and \xc3 broken \xe2\x82 letters " * 12
FINE = BAD.decode("utf-8", "replace")


def texts(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, raw binary").select("doc_id", F.col("raw").cast("string").alias("text"))


def test_strings_are_removed_by_bytes(spark):
    found = {r.doc_id: r for r in suffix_dedup.remove_repeats(texts(spark, (1, BAD), (2, b"\xff" + BAD), (3, None)), length=100).collect()}
    assert bytes(found[1].kept) != BAD and found[1].n_bytes == len(BAD)  # it repeats itself
    assert found[2].n_removed == len(BAD) and bytes(found[2].kept) == b"\xff"
    assert found[3].n_bytes == 0


@pytest.mark.parametrize("column", ["fingerprint", "score", "counts", "ids", "toxic"])
def test_broken_bytes_read_as_replaced(spark, column):
    docs = texts(spark, (1, BAD), (2, FINE.encode()), (3, b"something else entirely"))
    labels = spark.createDataFrame([(3, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    if column == "fingerprint":
        rows = simhash_dedup.simhash_groups(docs).select("doc_id", "fingerprint", "component_id").collect()
    elif column == "score":
        rows = lm_scoring.score_documents(docs, slices=2).collect()
    elif column == "counts":
        rows = quality_forest.judge_quality(docs, labels).collect()
    elif column == "ids":
        rows = sentencepiece_scan.encode(docs, PIECES, chunk=200).select("doc_id", "ids").collect()
    else:
        rows = toxicity_fm.toxicity_scores(docs, labels).select("doc_id", "score").collect()
    found = {r[0]: tuple(r)[1:] for r in rows}
    assert found[1] == found[2] and (column == "toxic" or found[1] != found[3])


def test_payloads_keep_their_bytes(spark):
    pages = spark.createDataFrame([(1, b"http://\xff.org/", BAD), (2, b"http://x.org/", None)], "page_id long, u binary, h binary").select(
        "page_id", F.col("u").cast("string").alias("url"), F.col("h").cast("string").alias("html")
    )
    rows = {r.record_id[-1]: r for r in zip_warc.packed_and_read(pages).collect()}
    assert bytes(rows["1"].payload) == BAD and rows["1"].length == len(BAD)
    assert hashlib.sha1(BAD).hexdigest().upper() == __import__("base64").b32decode(rows["1"].digest).hex().upper()


def test_samples_are_bounded_by_rows(spark):
    docs = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text number "), F.col("id") % 1500).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(2, "another one")], "doc_id long, text string"))
    rows = storage.one_text_per_id(docs, "doc_id", "text").groupBy("_climora_id").agg(F.min_by("text", "_climora_hash").alias("text")).collect()
    assert {r[0] for r in rows} == {1, 2} and len(rows) == 2
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality_forest.judge_quality(docs, labels).count() == 3001
    assert toxicity_fm.toxicity_scores(docs, labels).count() == 3001


def test_few_long_texts_fill_several_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SAMPLE_ROWS", 64)
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", 200)
    seen = []
    cut = suffix_dedup._splitters
    monkeypatch.setattr(suffix_dedup, "_splitters", lambda sample, buckets: seen.append((len(sample), buckets)) or cut(sample, buckets))
    rows = [(i, hashlib.sha512(str(i).encode()).hexdigest().encode() * 40) for i in range(12)]
    found = suffix_dedup.remove_repeats(texts(spark, *rows), length=100).collect()
    assert len(found) == 12 and all(r.n_removed > 0 for r in found)
    assert seen[0][0] == 64 and seen[0][1] > 4  # a whole sample although no text would have been drawn by hash


def test_keys_and_records_are_dealt_by_their_number(spark, monkeypatch):
    assert [storage.parts_for(n, 10) for n in (0, 1, 10, 11, 100)] == [1, 1, 1, 2, 10]
    monkeypatch.setattr(simhash_dedup, "PRINTS_PER_TASK", 2)
    prints = spark.createDataFrame([(i * 977, i) for i in range(9)], "print long, rep long")
    asked = []
    deal = type(prints).repartition
    monkeypatch.setattr(type(prints), "repartition", lambda self, n, *c: asked.append(n) or deal(self, n, *c))
    simhash_dedup.link_components(prints).count()
    assert asked[0] == 5
    asked.clear()
    monkeypatch.setattr(zip_warc, "BYTES_PER_TASK", 500)
    pages = spark.createDataFrame([(i, f"http://x.org/{i}", hashlib.sha512(str(i).encode()).hexdigest() * 3) for i in range(40)], "page_id long, url string, html string")
    assert zip_warc.packed_and_read(pages).count() == 40
    assert any(isinstance(n, int) and n > 5 for n in asked)
