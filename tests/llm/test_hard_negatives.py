"""Hard negatives against every pair scored."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartpost.llm import hard_negatives
from chartpost.llm.hard_negatives import Rows, angles_to, directions, mine, score_bounds

SCHEMA = "vec_id long, label int, embedding array<double>, row string, parts string, angles string"


def plain(rows, k=5):
    good = [
        (v, label, [math.floor(256 * x) for x in vector])
        for v, label, vector in rows
        if v is not None and label is not None and vector is not None
        and all(x is not None and math.isfinite(x) for x in vector)
    ]
    out = []
    for at, (v, label, vector) in enumerate(good):
        if v % 100:
            continue
        scored = [
            (-sum(a * b for a, b in zip(vector, other)), w, here == label)
            for i, (w, here, other) in enumerate(good)
            if i != at and len(other) == len(vector)
        ]
        positives = sorted((s, w) for s, w, same in scored if same)[:k]
        for p, w in positives:
            fits = sorted((s, n) for s, n, same in scored if not same and 80 * -p <= 100 * -s <= 100 * -p)[:k]
            out += [(v, w, rank, n, -p, -s) for rank, (s, n) in enumerate(fits, 1)]
    return sorted(out)


def vectors():
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(6)]
    rows = []
    for i in range(700):
        # A third of all rows have one label and lie around one centre.
        group = 0 if i % 3 == 0 else rng.randrange(6)
        vector = [x + rng.gauss(0, 0.4) for x in centres[group]]
        rows.append((i, group if rng.random() < 0.8 else rng.randrange(6), vector))
    rows += [(800, 1, rows[3][2]), (801, 1, rows[3][2]), (801, 1, rows[3][2]), (800, 2, rows[4][2]), (700, 3, [0.0] * 12)]
    rows += [(900, 0, [1.0, 2.0]), (901, 0, [1.0, 1.9]), (902, 4, [1.0, 1.8]), (903, 0, []), (1000, 0, []), (904, 2, [])]
    rows += [(None, 1, rows[0][2]), (500, None, rows[0][2]), (600, 1, None), (906, 1, [None] * 12), (907, 1, [math.nan] * 12), (908, 1, [math.inf] * 12)]
    return rows


@pytest.mark.parametrize("blocks", [(4096, 16384), (3, 50)])
def test_equals_every_pair_scored(spark, monkeypatch, blocks):
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", blocks[0])
    monkeypatch.setattr(hard_negatives, "ROWS", blocks[1])
    rows = vectors()
    table = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)
    got = sorted(map(tuple, mine(table, F.col("vec_id") % 100 == 0).collect()))
    assert got == plain(rows) and len(got) > 50


def test_bounds_hold_and_leave_rows_out():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(5, 8))
    parts = np.floor(256 * (centres[rng.integers(0, 5, 400)] + rng.normal(scale=0.02, size=(400, 8)))).astype(np.int64)
    parts[7] = 0
    parts[9] = parts[8] * 3
    norms, angles = angles_to(parts, directions(parts[10:200].astype(np.float64)))

    class Block(Rows):
        def __init__(self):
            self.parts, self.norms, self.cos, self.sin = parts, norms, np.cos(angles), np.sin(angles)

    block, unscored = Block(), 0
    for at in range(400):
        low, high = score_bounds(block, at, block)
        exact = parts @ parts[at]
        assert (low <= exact).all() and (exact <= high).all()
        unscored += int((high < np.sort(low)[-5]).sum())
    assert unscored > 400 * 400 // 2


def test_scores_beyond_63_bits_are_refused(spark):
    table = spark.createDataFrame([(0, 1, [1e12]), (1, 1, [1e12])], "vec_id long, label int, embedding array<double>")
    with pytest.raises(ValueError):
        mine(table, F.col("vec_id") == 0)


def test_empty_and_without_anchors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mine(empty, F.col("vec_id") % 100 == 0).count() == 0
    some = spark.createDataFrame([(1, 1, [1.0], "", "", "")], SCHEMA)
    assert mine(some, F.col("vec_id") % 100 == 0).count() == 0
    assert mine(some, F.lit(None).cast("boolean")).count() == 0
