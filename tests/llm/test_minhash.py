import random

import numpy as np

from agoralens.llm import minhash
from agoralens.llm.components import components
from tests.llm.conftest import words


def sets(rows, size=5):
    out = []
    for i, text in rows:
        w = (text or "").encode().lower().split()
        out.append((i, {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()))
    return out


def brute(rows, percent):
    """Smallest id reachable by comparing everything."""
    own = sets(rows)
    top = list(range(len(own)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(own)):
        for b in range(a):
            x, y = own[a][1], own[b][1]
            if None not in (own[a][0], own[b][0]) and x and y and 100 * len(x & y) >= percent * len(x | y):
                top[root(a)] = root(b)
    return sorted(((i, len(s), min(own[k][0] for k in range(len(own)) if root(k) == root(n)) if i is not None else None) for n, (i, s) in enumerate(own)), key=str)


def found(df, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_groups(df, **options).collect()), key=str)


def test_like_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r.doc_id, r.text) for r in df.collect()]
    assert found(df, percent=85) == brute(texts, 85)


def test_awkward(awkward):
    result = minhash.near_groups(awkward)
    assert found(awkward) == brute([(r.doc_id, r.text) for r in awkward.collect()], 80)
    kept = {r.doc_id: r.kept for r in result.collect()}
    assert kept[1] and not kept[2] and kept[4] and kept[5] and kept[None]


def test_empty(empty):
    df = minhash.near_groups(empty)
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"] and df.count() == 0


def test_star_of_edits_and_chain(spark):
    """Edits that are like their base but not like each other, and a chain of small steps."""
    draw = random.Random(5)
    base = words(3, 200)
    rows = [(1_000 - i, " ".join(draw.sample(base, 1)[0] + "x" if draw.random() < 0.012 else w for w in base)) for i in range(60)]
    rows.append((5_000, " ".join(base)))
    chain = words(4, 200)
    for i in range(12):
        chain = list(chain)
        chain[i * 15] = f"step{i}"
        rows.append((2_000 + i, " ".join(chain)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, percent=85) == brute(rows, 85)


def test_signature_estimates_likeness():
    draw = np.random.default_rng(1)
    gaps = []
    for n in (3, 40, 400, 3_000):
        pool = draw.integers(0, 2**63, 2 * n, dtype=np.uint64)
        a, b = pool[: int(1.5 * n)], pool[n // 2 :]
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        gaps.append(abs(np.mean(minhash.signature(a, 200) == minhash.signature(b, 200)) - true))
    assert max(gaps) < 0.12
    one = minhash.signature(np.array([5], np.uint64), 64)
    assert sorted(np.floor(one).astype(int)) == list(range(64))


def test_components_of_path_and_star(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1_000, 1_000 + i) for i in range(1, 400)]
    df = spark.createDataFrame(path + star, "a long, b long").repartition(7)
    roots = {r.node: r.root for r in components(df).collect()}
    assert all(roots[i] == 0 for i in range(301)) and all(roots[1_000 + i] == 1_000 for i in range(400))
    assert components(df.limit(0)).count() == 0
