import gc
import sys

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from agoralens.llm import piece_codec
from agoralens.llm.batches import map_rows
from tests.conftest import rows
from tests.llm.conftest import words

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_same_as_library_on_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    found = piece_codec.encode(docs, MODEL).collect()
    assert len(found) == len(texts)
    for r in found:
        assert list(r.ids) == library.encode(texts[r.doc_id])
        assert r.decoded == library.decode(list(r.ids))


def test_awkward(awkward, library):
    texts = sorted([(r.doc_id, r.text or "") for r in awkward.collect()], key=str)
    found = sorted([(r.doc_id, list(r.ids), r.decoded) for r in piece_codec.encode(awkward, MODEL).collect()], key=str)
    theirs = sorted([(i, library.encode(t), library.decode(library.encode(t))) for i, t in texts], key=str)
    assert found == theirs


def test_empty(empty):
    df = piece_codec.encode(empty, MODEL)
    assert df.columns == ["doc_id", "ids", "decoded"] and df.count() == 0


def test_heap_and_matrix_agree_with_library(library):
    coder = piece_codec.Codec(MODEL)
    texts = ["  two  spaces ", "▁mark▁▁", "aaaaaaaaaaaa", "日本語テキスト", "naïve œuvre", "tab\tand\r\n", "  ", "🙂🙂👩‍🔬", "İıẞß"]
    for text in texts:
        for run in coder.runs(text):
            assert coder.encode_long(run) == coder.encode_short([run])[0]
    assert list(coder.encode(texts)) == library.encode(texts)


def test_memory_is_bounded(monkeypatch, library):
    monkeypatch.setattr(piece_codec, "KNOWN_RUNS", 50)
    monkeypatch.setattr(piece_codec, "BATCH_CHARS", 200)
    coder = piece_codec.Codec(MODEL)
    texts = [f"text number {i} with some words w{i}" for i in range(200)]
    assert list(coder.encode(texts)) == library.encode(texts)


def test_decode_of_any_ids(spark, library):
    ids = [[1, 523, 28713, 2], [28705], [3 + 0xF0, 3 + 0x9F, 3 + 0x98, 3 + 0x80], [], None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "doc_id long, ids array<int>")
    expected = [(i, None if x is None else library.decode(x)) for i, x in enumerate(ids)]
    assert rows(piece_codec.decode(df, MODEL)) == sorted(expected)


def test_other_work_frees_the_codec(spark):
    """A worker that goes on to another stage holds no codec any more."""
    docs = spark.range(0, 200, 1, 8).selectExpr("id AS doc_id", "concat('text number ', id) AS text")
    assert len(piece_codec.encode(docs, MODEL).collect()) == 200

    def held(batches):
        n = sum(isinstance(x, piece_codec.Codec) for x in gc.get_objects())
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([n] * batch.num_rows, pa.int64()), batch.column(1)], names=batch.schema.names)

    assert {r.doc_id for r in map_rows(docs, held).collect()} == {0}


def test_remembered_runs_are_small(library):
    coder = piece_codec.Codec(MODEL)
    texts = [" ".join(words(5, 2_000))]
    assert list(coder.encode(texts)) == library.encode(texts)
    assert sum(map(sys.getsizeof, [*coder.known, *coder.known.values()])) < 120 * len(coder.known)
