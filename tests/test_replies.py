import random

import pytest

from agoralens.operators import replies
from tests.conftest import rows

SCHEMA = "id string, parent_id string, length long"


def brute(data):
    up, length = {}, {}
    for i, parent, n in sorted(data, key=lambda r: (str(r[0]), r[1] is None or r[1].startswith("t3_"), r[1] or "")):
        if i is None or i in up:
            continue
        up[i], length[i] = (parent.removeprefix("t1_") if parent and not parent.startswith("t3_") else None), n or 0
    above = {}
    for i in up:
        path, seen = [i], {i}
        while (p := up[path[-1]]) in up:
            if p in seen:
                path = None
                break
            path.append(p)
            seen.add(p)
        above[i] = path
    out = []
    for i, path in above.items():
        if path is None:
            out.append((i, None, None, None, None))
        else:
            inside = [j for j, other in above.items() if other and i in other]
            out.append((i, path[-1], len(path), len(inside), sum(length[j] for j in inside)))
    return sorted(out)


def found(spark, data):
    index = replies.reply_index(spark.createDataFrame(data, SCHEMA), ["length"])
    return sorted((r.id, r.root, r.depth, r["size"], r.total_length) for r in index.collect())


def tree(seed, n):
    draw = random.Random(seed)
    return [(f"c{i}", "t3_post" if i < 3 else f"t1_c{draw.randrange(i)}", draw.randint(0, 9)) for i in range(n)]


@pytest.mark.parametrize("data", [tree(1, 120), [(f"c{i}", f"t1_c{i - 1}" if i else "t3_p", i) for i in range(70)]], ids=["tree", "chain"])
def test_like_brute_force(spark, data):
    assert found(spark, data) == brute(data)


def test_odd_rows(spark):
    """Missing parents, cycles and what hangs below them, repeated ids, NULLs; many replies to one."""
    data = tree(2, 20) + [("lost", "t1_gone", 1), ("x", "t1_y", 1), ("y", "t1_x", 1), ("z", "t1_y", 4), ("self", "t1_self", 2)]
    data += [(None, "t1_c1", 1), ("free", None, None), ("c5", "t1_c0", 3)] + [(f"r{i}", "t1_c1", 1) for i in range(300)]
    data = [r for r in data if r[0] != "c5"] + [("c5", "t1_c0", 3)] * 2
    assert found(spark, data) == brute(data)


def test_empty(spark):
    assert found(spark, []) == []


def test_below(spark):
    data = tree(4, 60)
    index = replies.reply_index(spark.createDataFrame(data, SCHEMA))
    seeds = spark.createDataFrame([("c0",), ("c4",), ("c59",), ("c0",), ("nowhere",)], "id string")
    up = {i: p.removeprefix("t1_") for i, p, _ in data}
    pairs = []
    for i in up:
        p = up[i]
        while p in up:
            if p in ("c0", "c4", "c59"):
                pairs.append((p, i))
            p = up[p]
    assert rows(replies.below(index, seeds)) == sorted(pairs)
