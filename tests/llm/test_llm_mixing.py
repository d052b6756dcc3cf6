import math

import pytest
from pyspark.sql import functions as F

from climora.llm import source_mixing as M
from compare import connect, difference
from llm_cases import documents, empty

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("share", "budget"), [(0.99, 0.75), (0.9999, 1.0), (1.0, 1.7), (0.5, 0.2), (0.9995, 0.01)])
def test_equals_its_sql(spark, share, budget):
    frame = M.mix(spark.read.parquet(f"{SF}/documents.parquet"), target=M.Target(entropy_share=share, budget_share=budget))
    rows, off = difference(frame, connect(SF), M.mix_sql(share, budget))
    assert rows == 200 and not off


def words_by_source(frame):
    return {r.source: r.w for r in frame.groupBy("source").agg(F.sum(F.col("n_words") * F.col("copies")).alias("w")).collect()}


def test_quota_is_kept_to_a_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    target = M.Target(entropy_share=0.999, budget_share=1.5)
    frame = M.mix(docs, target=target)
    largest = frame.agg(F.max("n_words")).first()[0]
    placed = M._placed(docs, "doc_id", "source", "text", 0)
    for row in M.quotas(placed, target).collect():
        quota = row.passes * row.n_words + row.rest
        assert quota - largest < words_by_source(frame.where(F.col("source").eqNullSafe(row.source)))[row.source] <= quota


def shares(spark, counts):
    total = sum(counts)
    return spark.createDataFrame([(c, c / total) for c in counts], "n_words long, share double")


def test_exponent_meets_the_entropy(spark):
    counts = [9000, 500, 300, 200]
    a = M.exponent(shares(spark, counts), M.Target(entropy_share=0.8))

    def entropy(a):
        w = [(c / 10000) ** a for c in counts]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w) / math.log(4)

    assert entropy(a) >= 0.8 > entropy(a + 1e-6)


def test_exponent_holds_the_repetition(spark):
    counts = [9000, 500, 300, 200]
    a = M.exponent(shares(spark, counts), M.Target(max_repeat=2.0, budget_share=None))
    assert (200 / 9000) ** (a - 1) <= 2.0 < (200 / 9000) ** (a - 1 - 1e-6)
    b = M.exponent(shares(spark, counts), M.Target(max_repeat=3.0))
    z = sum((c / 10000) ** b for c in counts)
    assert (200 / 10000) ** (b - 1) / z <= 3.0


def test_whole_budget_keeps_every_document_and_column(spark):
    docs = documents(spark, extra=True)
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
    assert out.where("spot <> 'own'").count() == 0
    copies = {(r.doc_id, r.source): r.copies for r in M.mix(docs, target=M.Target(max_repeat=1.25, budget_share=None)).collect()}
    found = out.groupBy("doc_id", "source").count().collect()
    assert {(r.doc_id, r.source): r["count"] for r in found} == {k: v * (2 if k[0] == 3 else 1) for k, v in copies.items()}


def test_cases_without_words_or_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "a"), (2, "", "a"), (3, "one two", "b"), (None, "three", "b"), (4, "x", None)], "doc_id long, text string, source string"
    )
    rows = {r.doc_id: (r.n_words, r.copies) for r in M.mix(docs, target=M.Target(max_repeat=4.0, budget_share=None)).collect()}
    assert rows[1] == (0, 1) and rows[2] == (0, 1) and rows[3][1] >= 1 and rows[None][1] >= 1 and rows[4][1] >= 1
    assert M.mix(empty(spark)).count() == 0
    assert M.mixed_documents(empty(spark)).count() == 0


def test_main_path_is_native(spark):
    plan = M.mixed_documents(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
