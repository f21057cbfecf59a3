"""Hard negatives against plain integer products."""

import math
import random

import numpy as np
import pytest

from posofold.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """The rows of the result for (vec_id, embedding, label), one list entry each."""
    good = []
    for at, (i, v, label) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        good.append((at, i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for at, i, label, v in good:
        if i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, k, other) for k, j, other, w in good if k != at and len(w) == len(v)]
        scored.sort()
        for s, j, _, _ in [x for x in scored if x[3] == label][:5]:
            between = [x for x in scored if x[3] != label and 30 * s >= 100 * x[0] >= 90 * s]
            out += [(i, j, n, x[1], -s, -x[0]) for n, x in enumerate(between[:10], start=1)]
    return sorted(out)


def mined(spark, rows):
    return sorted(map(tuple, hn.mine(spark.createDataFrame(rows, SCHEMA)).collect()))


def vectors(n, dim, seed, labels=4):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    mean = [r.gauss(0, 1) for _ in range(dim)]
    rows = []
    for i in range(n):
        k = r.randrange(labels)
        rows.append((i, [(m + 0.6 * c + r.gauss(0, 0.3)) / 3 for m, c in zip(mean, centres[k])], k))
    return rows


@pytest.mark.parametrize("dim", [1, 7, 8, 19])
def test_equals_plain_products(spark, dim):
    rows = vectors(230, dim, dim)
    expected = brute(rows)
    assert expected and mined(spark, rows) == expected


def test_many_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(hn, "ANCHORS", 2)
    monkeypatch.setattr(hn, "CHUNK", 64)
    rows = [(i * 20, v, k) for i, v, k in vectors(400, 16, 3)]  # each fifth row is an anchor
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = vectors(120, 8, 5)
    rows += [(200, None, 1), (300, [0.1] * 8, None), (None, [0.1] * 8, 1), (400, [math.nan] * 8, 1), (500, [math.inf] * 8, 1)]
    rows += [(600, [0.1] * 7 + [None], 1), (700, [0.5] * 9, 1), (710, [0.4] * 9, 1), (720, [0.2] * 9, 2), (800, [], 1), (801, [], 1)]
    rows += [(0, *rows[0][1:]), (100, *rows[100][1:]), rows[5], rows[5], rows[6]]  # repeated rows, anchors too
    rows += [(k, [0.3] * 8, k % 3) for k in range(900, 950)]  # ties
    assert mined(spark, rows) == brute(rows)


def test_wide_components(spark):
    r = random.Random(9)
    rows = [(i, [r.choice((1.0, 300.5, -7000.25, 131071.0)) for _ in range(12)], i % 3) for i in range(101)]
    assert mined(spark, rows) == brute(rows)


def test_empty_and_clashing_columns(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [0.1], 1)]) == []
    rows = vectors(101, 8, 2)
    names = ["row", "dim", "planes", "goals", "score", "rank", "anchor_id", "chunk"]
    wide = spark.createDataFrame([(*x, *names) for x in rows], f"{SCHEMA}, " + ", ".join(f"{n} string" for n in names))
    assert sorted(map(tuple, hn.mine(wide).collect())) == brute(rows)


def test_a_label_with_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "CHUNK", 100)
    rows = [(i, v, 0 if i % 3 == 0 else k) for i, v, k in vectors(500, 8, 11, labels=9)]
    assert mined(spark, rows) == brute(rows)
