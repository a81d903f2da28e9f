import hashlib

import pytest

from agoralens.llm import substrings
from tests.llm.conftest import words


def brute(rows, window=50):
    first = {}
    for i, text in rows:
        w = (text or "").encode().split()
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in substrings.remove_repeats(df).collect()), key=str)


def test_like_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_awkward(awkward):
    assert found(awkward) == brute([(r.doc_id, r.text) for r in awkward.collect()])


@pytest.mark.parametrize("length, removed", [(49, 0), (50, 50), (51, 51), (130, 130)])
def test_passage_lengths(spark, length, removed):
    passage = words(9, length)
    rows = [(7, " ".join(words(1, 80) + passage + words(2, 80))), (3, " ".join(words(5, 33) + passage)), (9, " ".join(passage + words(4, 70)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substrings.remove_repeats(df).collect()} == {3: 0, 7: removed, 9: removed}
    assert found(df) == brute(rows)


def test_kept_text_and_repeats_within_a_text(spark):
    loop = "one two three four five " * 40
    rows = [(1, loop), (2, "before " + loop + "after"), (2, "other text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute(rows)
    kept = {r.n_words: r.kept for r in substrings.remove_repeats(df, texts=True).collect()}
    assert kept[202] == "before after"


def test_empty(empty):
    assert substrings.remove_repeats(empty).count() == 0
