import hashlib

import pytest
from pyspark.sql import functions as F

from agoralens.llm import mixing, spots
from tests.conftest import plan
from tests.llm.conftest import words


def edited(rows):
    """(id, chars, digest) by the definition; `rows` have distinct ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = []
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        out.append((i, len(text), hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest()))
    return sorted(out)


def test_edited_texts_like_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = spots.fingerprint_and_edited(df)
    assert "Python" not in plan(found)
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found.collect()) == edited([(r.doc_id, r.text) for r in df.collect()])
    assert found.where("near_edited NOT BETWEEN 0 AND 1 OR near_next NOT BETWEEN 0 AND 1").count() == 0


def signatures(text, cover=False):
    """Chains by plain loops: the anchors before a content word, the word, the next content word. `cover`:
    and pairs of content words where neither has an anchor before it."""
    tokens = [w for w in __import__("regex").split(r"[^\p{L}\p{M}\p{N}]+", (text or "").lower()) if w]
    if not tokens:
        return set()
    parts, before = [], ["^"]
    for w in tokens:
        if w in spots.ANCHORS:
            before.append(w)
        else:
            parts.append((tuple(before), w))
            before = []
    tail = tuple(before)
    out = set()
    for k, (anchors, w) in enumerate(parts):
        if anchors:
            out.add((anchors, w, parts[k + 1][1] if k + 1 < len(parts) else ""))
        elif cover and k + 1 < len(parts) and not parts[k + 1][0]:
            out.add(("", w, parts[k + 1][1]))
    if tail:
        out.add((tail, None, ""))
    return out


def test_likenesses_like_brute_force(spark):
    """Both likenesses of every document, from plain sets of covering signatures."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    order = sorted(((r.doc_id, r.text or "") for r in df.collect()), reverse=True)
    expected = {}
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        cut = len(text) // 3
        own, other, following = (signatures(t, cover=True) for t in (text, text[: len(text) - cut] + after[:cut], after))
        expected[i] = [len(own & s) / len(own | s) if own | s else 1.0 for s in (other, following)]
    for r in spots.fingerprint_and_edited(df).collect():
        assert [r.near_edited, r.near_next] == pytest.approx(expected[r.doc_id]), r.doc_id


def test_set_sizes_like_brute_force(spark, awkward):
    text = "The cat sat on the mat, and the dog of the house ran. Der Hund und die Katze"
    df = spark.createDataFrame([(1, text), (2, text.upper()), (3, "plain words only"), (4, "the"), (5, None)], "doc_id long, text string")
    found = {r.doc_id: (r.s.n, r.s.least) for r in df.select("doc_id", spots.sketch("text").alias("s")).collect()}
    assert found[1] == found[2] and [found[i][0] for i in (3, 4, 5)] == [1, 1, 0]
    assert found[1][0] == len(signatures(text))
    for r in awkward.select("text", spots.sketch("text").alias("s")).collect():
        assert r.s.n == len(signatures(r.text))


def test_fingerprints_of_awkward_rows(awkward, empty):
    found = spots.fingerprint_and_edited(awkward).collect()
    assert len(found) == awkward.count()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    assert by[7][0].fingerprint == by[8][0].fingerprint and by[1][0].fingerprint == by[2][0].fingerprint
    assert by[4][0].n_chars == 0 and by[8][0].near_next == 1.0
    assert len({(r.edited_sha256, r.fingerprint) for r in by[2]}) == 1
    assert spots.fingerprint_and_edited(empty).count() == 0


def test_whole_sets_of_long_texts(spark):
    """Long texts that differ only in the signatures with the largest hashes are not the same."""
    parts = [f"the {w}x {w}y" for w in dict.fromkeys(words(9, 600))]
    df = spark.createDataFrame([(k, p) for k, p in enumerate(parts)], "k int, text string")
    first = {r.k: r.h[-1] for r in df.where("k > 0").select("k", spots.spots(F.concat(F.lit("a b "), "text")).alias("h")).collect()}
    last = sorted(first, key=first.get)[-20:]
    texts = [" ".join(parts), " ".join(p.replace("the ", "der ") if k in last else p for k, p in enumerate(parts))]
    sets = [signatures(t) for t in texts]
    rows = spots.fingerprint_and_edited(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()
    assert min(map(len, sets)) > 400 and sets[0] != sets[1]
    assert rows[0].fingerprint != rows[1].fingerprint
    for r in rows:
        assert r.near_next == pytest.approx(len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
        assert len(r.fingerprint.split(":")[1].split(",")) == int(r.fingerprint.split(":")[0]) == len(sets[r.doc_id])


def test_fingerprints_cover_texts_without_anchors(spark):
    """Every word counts: in texts without a listed word, and in long stretches without one."""
    bare = list(dict.fromkeys(w + "x" for w in words(11, 300)))
    for start in ([], ["the"]):
        plain = [*start, *bare]
        rows = [(k, " ".join([*plain[:k], "changed", *plain[k + 1 :]])) for k in range(3, len(plain), 17)]
        found = spots.fingerprint_and_edited(spark.createDataFrame([*rows, (0, " ".join(plain))], "doc_id long, text string")).collect()
        assert len({r.fingerprint for r in found}) == len(rows) + 1
        assert all(0.9 < r.near_next < 1 for r in found if r.doc_id) and all(0.3 < r.near_edited < 1 for r in found if r.doc_id)
        assert {int(r.fingerprint.split(":")[0]) for r in found} == {len(bare) - 1 + len(start) - (1 if start else 0)}


def test_ids_with_several_texts(spark):
    """Hashes of any distance: of several rows with the next id one and the same text follows."""
    texts = [f"the text number {k} of an id and the next" for k in range(60)]
    df = spark.createDataFrame([(k % 5, t) for k, t in enumerate(texts)], "doc_id long, text string")
    rows = spots.fingerprint_and_edited(df).collect()
    assert len(rows) == 60
    follows = {}
    for r, t in ((r, t) for r in rows for t in texts if len(t) == r.n_chars):
        cut = len(t) // 3
        for other in texts:
            if hashlib.sha256((t[: len(t) - cut] + other[:cut]).encode()).hexdigest() == r.edited_sha256:
                follows.setdefault(r.doc_id, set()).add(other[:cut])
    assert set(follows) == set(range(5))


def test_single_row_is_its_own_next(spark):
    df = spark.createDataFrame([(5, "the one text of a table is its own next")], "doc_id long, text string")
    r = spots.fingerprint_and_edited(df).first()
    assert r.near_next == 1.0 and r.n_chars == 39


def test_near_pairs_like_brute_force(spark):
    mixed = [w for k, w in enumerate(words(6, 400)) for w in ((w, "the") if k % 2 else (w,))]
    rows = [(i, " ".join([*mixed[:k], "changed", *mixed[k + 1 : 560 - k]])) for i, k in enumerate((10, 20, 30, 60, 100, 150))]
    rows += [(10, rows[0][1]), (11, "other text of the kind"), (12, None), (13, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: signatures(t) for i, t in rows}
    expected = {
        (a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        for a in sets for b in sets if a < b and 10 not in (a, b) and sets[a] and sets[b]
    }
    expected = {p: v for p, v in expected.items() if v >= 0.8}
    found = {(r.a, r.b): r.likeness for r in spots.near_pairs(df).collect()}
    assert found.keys() == expected.keys() and len(found) > 3
    assert all(found[p] == pytest.approx(expected[p]) for p in found)
    assert {r.doc_id: r.representative for r in spots.representatives(df).collect()}[10] == 0


def test_pairs_at_the_threshold(spark):
    """A set of 28 in one of 35 is 0.8 alike; what they share is rarer than the rest."""
    parts = [f"the {w}x {w}y" for w in dict.fromkeys(words(12, 200))]
    a, b = parts[:35], parts[:28]
    rows = [(1, a), (2, b), (3, [*parts[40:100], *a[28:]]), (4, [*parts[100:160], *a[28:]])]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    assert [(r.a, r.b, r.likeness) for r in spots.near_pairs(df).collect()] == [(1, 2, 0.8)]


def fill(sizes, weights, share, most):
    """Targets by giving out shares and resharing what is too much, round after round."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, rest = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        if not open_:
            return full
        level = (rest - sum(full.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] >= most * sizes[s]]
        if not over:
            return full | {s: level * weight[s] for s in open_}
        full |= {s: most * sizes[s] for s in over}


def test_targets_and_budgets(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    df = df.withColumn("source", F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") % 3 == 0, F.lit("src0")).otherwise(F.col("source")))
    found = mixing.mix(df)
    assert "Python" not in plan(found)
    rows = found.collect()
    sizes, taken, targets = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        targets[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    expected = fill(sizes, (5, 2, 1), 1.5, 2.0)
    for s in sizes:
        assert targets[s] == pytest.approx(expected[s])
        assert taken[s] == int(targets[s] + 1e-6)
    assert sorted(map(str, mixing.mix(df.repartition(5)).collect())) == sorted(map(str, rows))


def test_mix_edges(awkward, empty, spark):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count() and all(r.taken == 0 for r in rows if r.size == 0)
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(awkward.where("text IS NULL")).where("taken != 0").count() == 0


def test_copies_are_what_is_taken(awkward):
    mixed = mixing.mix(awkward, with_row=True)
    out = mixing.copies(mixed)
    assert out.columns == awkward.columns
    wanted = {(r.source): r.t for r in mixed.groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    got = {r.source: r.t for r in out.groupBy("source").agg(F.sum(mixing.words("text")).alias("t")).collect()}
    assert got == {s: t for s, t in wanted.items() if t}
    assert out.where("n_chars != length(text)").count() == 0
