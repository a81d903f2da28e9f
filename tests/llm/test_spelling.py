import random
import re
import zlib
from collections import Counter

import pytest

from agoralens.llm import spelling
from tests.llm.conftest import words as made


def slipped(doc_id, run):
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run


def counted(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen = Counter(slipped(i, run.translate(lower)) for i, text in rows for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""))
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(vocabulary):
    form, out = {}, []
    for w, n in vocabulary.items():
        partners = [(-vocabulary[v], v) for v in vocabulary if near(w, v)]
        best = min(partners, default=None)
        form[w] = best[1] if best and -best[0] >= 2 * n else None
        out.append((w, n, len(partners)))

    def last(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], last(w), n, k, vocabulary[form[w]] if form[w] else None) for w, n, k in out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_like_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert rows_of(spelling.variants(df)) == brute(counted([(r.doc_id, r.text) for r in df.collect()]))


@pytest.mark.parametrize("bucket", [spelling.BUCKET, 3])
def test_pairs_like_brute_force(spark, bucket):
    """Dense small alphabets: edits at every place, repeated letters, both halves alike; fine buckets too."""
    draw = random.Random(7)
    vocabulary = {"".join(draw.choice("aé" if i % 2 else "abc") for _ in range(draw.randint(5, 8))): draw.randint(3, 40) for i in range(300)}
    df = spark.createDataFrame(list(vocabulary.items()), "word string, n long")
    got = {r.word: (r.n_near, r.best_n, r.best) for r in spelling.near_words(df, bucket=bucket).collect()}
    for w in vocabulary:
        partners = [(-vocabulary[v], v) for v in vocabulary if near(w, v)]
        assert got.get(w) == ((len(partners), -min(partners)[0], min(partners)[1]) if partners else None)


def test_blocks_of_a_bucket(monkeypatch):
    """One bucket is searched block by block with the same pairs."""
    words = sorted({"abc" + w for w in made(3, 300) if len(w) == 3})
    index = spelling.Index(words)
    for w in words:
        replaced, longer = index.near(w)
        assert {words[i] for i in spelling.places(replaced)} == {v for v in words if near(w, v)} and not longer


def test_chains(spark):
    """Forms lead over several words to the last; equal counts go by code points."""
    text = " ".join(["aaaaa"] * 3 + ["aaaab"] * 6 + ["aaabb"] * 12 + ["aabbb"] * 24 + ["zzzzz"] * 3 + ["zzzzy"] * 6 + ["zzzzé"] * 6)
    rows = [(1, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(spelling.variants(df))
    assert got == brute(counted(rows))
    if "zzzzz" in counted(rows):
        assert [r[1] for r in got if r[0] == "zzzzz"] == ["zzzzy"]


def test_odd_tables(spark, awkward, empty):
    assert rows_of(spelling.variants(awkward)) == brute(counted([(r.doc_id, r.text) for r in awkward.collect()]))
    assert spelling.variants(empty).count() == 0
