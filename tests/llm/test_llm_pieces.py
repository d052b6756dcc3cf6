import random

import numpy as np
import pytest
import sentencepiece

from climora.llm import sentencepiece_scan as P
from climora.llm.queries import PIECES, op10_sentencepiece
from llm_cases import documents, empty, sentence


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def scrambled(rng, n):
    parts = ["a", "b", "ab", " ", "the", "  ", "é", "字", "ing", "    ", "aaa", "\n", "tion", "an", "😀", "er", "lich"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(0, n)))


def test_small_texts_equal_the_library(library):
    rng = random.Random(1)
    texts = [scrambled(rng, 80) for _ in range(300)] + ["x" * 90, "the" * 40, " " * 70, ""]
    model = P.pieces(PIECES)
    for text, ids in zip(texts, model.ids_of([P.normalised(t) for t in texts])):
        assert ids.tolist() == library.encode(text)
        assert model.decoded(ids.tolist()) == text


def test_remembered_units_are_forgotten_without_a_change(library, monkeypatch):
    monkeypatch.setattr(P, "_UNITS_KEPT", 8)
    rng = random.Random(5)
    model = P.Pieces(PIECES)
    for _ in range(30):  # single spaces, several spaces, the sign itself, empty, and stretches from inside a word
        texts = [rng.choice(["the  an", "the an", "a ▁b", "", " ", "x ", "1\n2 é"]) + scrambled(rng, 9) for _ in range(6)]
        made = model.ids_of([P.normalised(t) for t in texts])
        assert [ids.tolist() for ids in made] == [library.encode(t) for t in texts]
        assert "".join(model.text[i] for i in model.ids_of(["tion▁the"])[0]) == "tion▁the"


def test_heap_and_many_at_once_agree(library):
    rng = random.Random(2)
    model = P.pieces(PIECES)
    for _ in range(200):
        unit = scrambled(rng, 14).replace(" ", "")[:40]
        if unit:
            tokens, _ = model.segment([unit])
            alone = [model.known[p][0] if p in model.known else -1 - ord(p) for p in model.joined(unit)]
            assert tokens.tolist() == alone


@pytest.mark.parametrize("chunk", [3, 5, 17, 64])
def test_scan_over_spark_equals_the_library(spark, library, chunk):
    rng = random.Random(chunk)
    texts = [scrambled(rng, 60).replace(" ", "" if k % 2 else " ") for k in range(25)] + ["a" * 200, None, "", sentence(rng, 40)]
    frame = spark.createDataFrame(list(enumerate(texts)) + [(3, texts[3])], "doc_id long, text string").repartition(3)
    rows = P.encode(frame, PIECES, chunk=chunk).collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        assert row.ids == library.encode(row.text or "")


def test_groups_of_chunks_are_scanned_too(spark, library, monkeypatch):
    monkeypatch.setattr(P, "GROUP", 4)
    text = sentence(random.Random(9), 300).replace(" ", "")
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert P.encode(frame, PIECES, chunk=37).first().ids == library.encode(text)


def test_product_is_associative():
    rng = np.random.default_rng(3)
    a, b, c = (np.where(rng.random((5, 5)) < 0.5, P._NEVER, 0) for _ in range(3))
    assert (P.times(P.times(a, b), c) == P.times(a, P.times(b, c))).all()


def test_round_trip_of_the_cases_and_clashing_columns(spark, library):
    frame = documents(spark, extra=True)
    decoded = P.decode(P.encode(frame, PIECES), PIECES)
    assert [c for c in decoded.columns if c not in ("ids", "decoded")] == [c for c in frame.columns if c != "ids"]
    for row in decoded.collect():
        assert row.decoded == (row.text or "").replace("▁", " ")
        assert row.ids == library.encode(row.text or "")


def test_query_and_empty_table(spark, tmp_path):
    documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    rows = op10_sentencepiece(spark, str(tmp_path)).collect()
    assert len(rows) == documents(spark).count()
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in rows)
    assert P.encode(empty(spark), PIECES).count() == 0


def test_decoding_takes_special_ids_broken_bytes_and_null(spark):
    model = P.pieces(PIECES)
    assert model.decoded([1, *model.ids_of([P.normalised("hi")])[0].tolist(), 2]) == "hi"
    assert model.decoded([model.of_byte[0xC3]]) == "�"
    frame = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in P.decode(frame, PIECES).collect()] == ["", ""]
