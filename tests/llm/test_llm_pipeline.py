import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from climora.llm import simhash_dedup, source_mixing, toxicity_fm
from climora.llm.queries import PIECES
from llm_cases import documents
from test_llm_simhash import brute_groups, brute_print
from test_llm_suffix import brute


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = documents(spark).dropDuplicates(["doc_id"]).withColumn("doc_id", F.col("doc_id") + 1000)
    given.unionByName(more).write.parquet(str(folder / "documents.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(str(folder / "labels.parquet"))
    return str(folder)


def test_stages_are_named_and_ordered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "suffix_array_dedup", "source_mixing", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_equals_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    machine = toxicity_fm.fit_toxicity(docs, spark.read.parquet(f"{tables}/labels.parquet").where(~toxicity_fm.held_out("doc_id")))
    rows = [r for r in rows if machine.score(r[1]) < 0.7]
    groups = brute_groups([(r[0], brute_print(r[1])) for r in rows])
    rows = [r for i, r in enumerate(rows) if groups[i] == r[0]]
    left = brute([(i, t) for i, t, _ in rows], 100)
    rows = [(i, None if t is None else left[i][3].decode("utf-8", "ignore"), s) for i, t, s in rows if left[i][1] == 0 or left[i][3]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = {r.doc_id: r.copies for r in source_mixing.mix(frame, target=corpus_pipeline.MIX_TARGET).collect()}
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = sorted(((i, s, model.encode(t or "")) for i, t, s in rows for _ in range(copies[i])), key=repr)
    out = corpus_pipeline.run(spark, tables)
    assert out.columns == ["doc_id", "source", "n_ids", "ids"]
    assert sorted(((r.doc_id, r.source, list(r.ids)) for r in out.collect()), key=repr) == want
    assert {i for i, _, _ in want} == {r[0] for r in rows}


def test_every_stage_takes_the_cases_and_keeps_columns(spark, tables):
    frame = documents(spark, extra=True)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, tables)
        if name != "sentencepiece":
            assert out.columns == frame.columns
        assert out.count() > 0
        assert stage(spark, frame.limit(0), tables).count() == 0


def test_cut_texts_are_counted_anew(spark, tables):
    text = "the quick brown fox " * 6
    frame = spark.createDataFrame([(1, text, 5), (2, text + "and more", 7), (3, None, 9), (4, text, 3)], "doc_id long, text string, n_chars long")
    rows = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.cut_repeats(spark, frame, tables).collect()}
    kept = brute([(1, text), (2, text + "and more"), (4, text)], 100)
    assert 4 not in rows and rows[3] == (None, 9)
    assert rows[2] == (kept[2][3].decode(), len(kept[2][3]))


def test_near_copies_share_a_print_within_four_bits(spark, tables):
    kept = simhash_dedup.simhash_dedup(spark.read.parquet(f"{tables}/documents.parquet"))
    prints = np.array([brute_print(r.text) for r in kept.collect()], np.uint64)
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
    np.fill_diagonal(apart, 64)
    assert apart.min() > 4


def test_stages_ask_for_one_python_worker_per_task(spark, tables):
    """Where two steps in Python follow each other in a stage, each core has two workers from then on."""
    plan = corpus_pipeline.cut_repeats(spark, documents(spark), tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan


def test_characters_cut_in_two_are_left_out(spark, tables):
    same = "ab" * 60
    rows = [(1, "ü" + same, "s"), (2, "ý" + same, "s"), (3, "x" + same + "字", "s"), (4, same, "s"), (5, None, "s"), (6, "", "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = brute([(i, t) for i, t, _ in rows], 100)
    want = [(i, None if t is None else left[i][3].decode("utf-8", "ignore")) for i, t, _ in rows if left[i][1] == 0 or left[i][3]]
    assert sorted((r.doc_id, r.text) for r in corpus_pipeline.cut_repeats(spark, frame, tables).collect()) == want
