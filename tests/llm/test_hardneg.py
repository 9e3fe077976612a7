"""Hard negatives against all pairs; the tree against all distances."""

import math

import numpy as np
import pytest

from roadlens.llm import hardneg

SCHEMA = "vec_id long, embedding array<{}>, label int, vec string, leaf int, block int, score long"


def frame(spark, rows, element="float"):
    return spark.createDataFrame([(i, v, label, "x", 1, 2, 3) for i, v, label in rows], SCHEMA.format(element))


def brute(rows, every):
    fit = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fit.append((i, label, [math.floor(256 * float(x)) for x in v]))
    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    out, done = [], set()
    for i, label, v in fit:
        if i % every or (i, label, tuple(v)) in done:
            continue
        done.add((i, label, tuple(v)))
        positives = sorted((-dot(v, w), j) for j, m, w in fit if m == label and j != i)[:5]
        for p, pid in positives:
            near = sorted((-dot(v, w), j) for j, m, w in fit if m != label)
            near = [(n, j) for n, j in near if 80 * -p <= 100 * -n <= 100 * -p][:5]
            out += [(i, pid, k + 1, j, -p, -n) for k, (n, j) in enumerate(near)]
    return sorted(out)


def some_rows(seed=4, n=700, d=5, element=np.float32):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d)) * 2
    rows = []
    for i in range(n):
        v = (centres[rng.integers(12)] + rng.normal(size=d) * 0.4).astype(element)
        rows.append((i, [float(x) for x in v], int(rng.integers(4))))
    rows += [(1000 + i, rows[3][1], 1) for i in range(250)]  # many copies of one vector, ties on ids
    rows += [(2000 + 10 * i, rows[3][1], 2) for i in range(40)]
    rows += [rows[10], rows[20], rows[20]]  # repeated rows, one of them an anchor
    rows += [(30, rows[50][1], 3), (30, rows[50][1], 0)]  # one id, other contents
    rows += [
        (None, rows[1][1], 1), (3000, None, 1), (3010, rows[1][1], None), (3020, [], 1), (3030, rows[1][1][:2], 1),
        (3040, [float("nan"), *rows[1][1][1:]], 1), (3050, [float("inf")] * d, 1), (3060, [None] * d, 1), (3070, [0.0] * d, 2),
    ]
    return rows


@pytest.mark.parametrize("element", ["float", "double"])
def test_all_pairs(spark, element):
    rows = some_rows(element=np.float32 if element == "float" else np.float64)
    got = hardneg.hard_negatives(frame(spark, rows, element), anchor_every=10, sample=400, degree=4, leaf=15, block_rows=60)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows, 10)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 500


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.0], 1), (2, [0.8, 0.1], 2), (3, [-1.0, 0.0], 2)]
    assert sorted(map(tuple, hardneg.hard_negatives(frame(spark, rows)).collect())) == brute(rows, 100)
    assert hardneg.hard_negatives(frame(spark, [])).count() == 0
    assert hardneg.hard_negatives(frame(spark, [(7, [1.0], 1)])).count() == 0


def test_tree_leaves_out_what_it_may():
    rng = np.random.default_rng(0)
    rows = np.floor(256 * (rng.normal(size=(30, 3)) * 5)[rng.integers(30, size=4000)] + rng.normal(size=(4000, 3)) * 40)
    tree = hardneg.Tree(rows[:1000], degree=6, leaf=20)
    leaf = tree.assign(rows)
    for x in range(tree.leaves):
        held = rows[leaf == x]
        for number, kid in tree.paths[x] if len(held) else []:
            node = tree.nodes[number]
            d = hardneg.distances(held, node.points)
            node.low[:, kid], node.high[:, kid] = np.minimum(node.low[:, kid], d.min(0)), np.maximum(node.high[:, kid], d.max(0))
            norms = (held * held).sum(1)
            node.norms[kid] = min(node.norms[kid, 0], norms.min()), max(node.norms[kid, 1], norms.max())
    asked = rows[::40]
    s = asked @ rows.T
    high = s.max(1)
    low = np.where(high > 0, 0.9 * high, 1.1 * high)
    seen = np.zeros((len(asked), tree.leaves), dtype=bool)
    for x, which in tree.visits(asked, low, high):
        seen[which, x] = True
    a, b = np.nonzero((s >= low[:, None]) & (s <= high[:, None]))
    assert seen[a, leaf[b]].all()
    assert seen.mean() < 0.4


def test_scores_are_exact():
    rng = np.random.default_rng(1)
    for size in (100, 5_000, 10_000_000):
        a, b = (rng.integers(-size, size, (20, 8)) for _ in range(2))
        assert (hardneg.scores(a.astype(float), b.astype(float)) == a @ b.T).all()
