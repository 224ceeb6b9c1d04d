"""Hard negatives against brute force: nulls, ties, repeated rows, several
lengths, huge components, many tiles."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import rtree

SCHEMA = "vec_id long, embedding array<double>, label int, v int, tile string, dim int, score long, rank int, id string"
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def brute(rows, every, positives=5, negatives=5, low=80):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x * 256) for x in v):
            continue
        q = [math.floor(x * 256) for x in v]
        if i not in kept or (label, [float(x) for x in q]) < (kept[i][0], [float(x) for x in kept[i][1]]):
            kept[i] = (label, q)
    out = []
    for a, (label, q) in kept.items():
        if a % every:
            continue
        score = {i: min(max(sum(x * y for x, y in zip(q, w)), LEAST), MOST) for i, (_, w) in kept.items() if i != a and len(w) == len(q)}
        best = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in best if kept[i][0] == label][:positives]:
            fits = [i for i in best if kept[i][0] != label and low * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(fits[:negatives])]
    return sorted(out)


def mined(spark, rows, every):
    df = spark.createDataFrame([(*r, 1, "t", 2, 3, 4, "x") for r in rows], SCHEMA).repartition(4)
    return sorted(tuple(r) for r in rtree.mine(df, F.col("vec_id") % every == 0, F.col("label")).collect())


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    v = centres[rng.integers(0, 4, n)] + rng.normal(size=(n, dim)) * 0.7
    return [(i, [float(x) for x in w], int(rng.integers(0, 4))) for i, w in enumerate(v)]


def hard_rows():
    rows = clustered(300, 6, 1)
    rows += [(1000 + k, rows[3][1], rows[3][2]) for k in range(40)] + [(2000 + k, rows[3][1], (rows[3][2] + 1) % 4) for k in range(40)]  # ties
    rows += [(None, [1.0] * 6, 1), (3000, None, 1), (3010, [], 1), (3020, [1.0, None, 0.0, 0.0, 0.0, 0.0], 2), (3030, [math.nan] * 6, 2),
             (3040, [math.inf] + [0.0] * 5, 1), (3050, [1.0] * 6, None), (3060, [0.0] * 6, 0), (3061, [0.0] * 6, 1)]
    rows += [(4000 + k, [0.5 * k, -1.0], k % 2) for k in range(20)] + [(5000, [1.0, 2.0, 3.0], 7)]  # other lengths; one alone
    rows += [rows[10], rows[10], (20, rows[5][1], 3)]  # repeated rows, two rows of one id
    return rows


@pytest.mark.parametrize("leaf, fan, tile, anchors, directory", [(256, 16, 16384, 4096, 1024), (8, 2, 40, 5, 3)])
def test_mining(spark, monkeypatch, leaf, fan, tile, anchors, directory):
    for name, value in (("LEAF", leaf), ("FAN", fan), ("TILE", tile), ("ANCHORS", anchors), ("DIRECTORY", directory)):
        monkeypatch.setattr(rtree, name, value)
    rows = hard_rows()
    got = mined(spark, rows, 10)
    assert got == brute(rows, 10) and len(got) > 300


def test_large_components(spark):
    rng = np.random.default_rng(2)
    scale = [1e-3, 1.0, 1e5, 1e9, 1e30, 1e200]
    rows = [(i, [float(x) for x in rng.normal(size=4) * scale[i % 6]], int(rng.integers(0, 2))) for i in range(120)]
    assert mined(spark, rows, 3) == brute(rows, 3)


def test_one_label_and_empty(spark):
    assert mined(spark, [(i, [1.0, float(i)], 1) for i in range(30)], 5) == []
    assert mined(spark, [], 5) == []


def test_quantised(spark):
    values = [0.1, -0.1, 1 / 256, -1e-300, 2.0 ** 60 + 2 ** 10, -3e100, 0.0]
    df = spark.createDataFrame([(values,)], "e array<double>")
    assert df.select(rtree.quantised(F.col("e"), 256)).first()[0] == [float(math.floor(x * 256)) for x in values]


def test_boxes_bound_every_score():
    rng = np.random.default_rng(3)
    for scale in (10, 1e8, 1e18):
        v = np.floor(rng.normal(size=(500, 8)) * scale)
        q = np.floor(rng.normal(size=8) * scale)
        least, most = rtree.bounds(v.min(0)[None], v.max(0)[None], q)
        exact = [sum(int(x) * int(y) for x, y in zip(w, q)) for w in v]
        assert int(least[0]) <= min(exact) and max(exact) <= int(most[0])


def test_packing_keeps_every_row_once():
    rng = np.random.default_rng(4)
    for n in (0, 1, 7, 8, 100, 1000):
        keys = rng.integers(0, 5, (n, 2)).astype(float)
        assert sorted(rtree.str_order(keys, 8).tolist()) == list(range(n))


def test_search_prunes():
    """Clustered vectors: most leaves lie outside the windows or below the k-th score."""
    rng = np.random.default_rng(5)
    centres = np.floor(rng.normal(size=(32, 6)) * 2560)
    group = np.sort(rng.integers(0, 32, 4096))
    v = centres[group] + np.floor(rng.normal(size=(4096, 6)) * 20)
    order = rtree.str_order(v[:, :2], 64)
    leaves = [(order[s:s + 64].astype(np.int64), np.zeros(64, np.int64), v[order[s:s + 64]]) for s in range(0, 4096, 64)]
    tree, seen = rtree.Tree(leaves), []
    plain = rtree.scores
    try:
        rtree.scores = lambda *a: seen.append(1) or plain(*a)
        (ids, score), = tree.search(v[0], 0, 1, False, [(LEAST, MOST)], 5)
    finally:
        rtree.scores = plain
    exact = sorted(((-int(s), i) for i, s in enumerate((v @ v[0]).tolist()) if i), )[:5]
    assert [(-s, i) for s, i in zip(score.tolist(), ids.tolist())] == exact and len(seen) < 16
