"""Hard negatives against a plain version, and on awkward tables."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicframe.llm import bond_scan

from . import brute

_VECTORS = "vec_id bigint, label bigint, vector array<bigint>"


def mined(spark, rows, every=10, **settings):
    table = spark.createDataFrame(rows, _VECTORS)
    anchors = [r for r in rows if r[0] % every == 0]
    got = bond_scan.mine(table, table.where(F.col("vec_id") % every == 0), **settings)
    return sorted(tuple(r) for r in got.collect()), anchors


def clustered(n=400, dims=20, labels=4, seed=1, scale=50):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, scale, (labels * 2, dims))
    which = rng.integers(0, len(centres), n)
    points = np.floor(centres[which] + rng.normal(0, scale / 2, (n, dims))).astype(int)
    return [(i, int(which[i]) % labels, points[i].tolist()) for i in range(n)]


@pytest.mark.parametrize("settings", [{}, {"pack_bytes": 2000}, {"positives": 2, "negatives": 3, "least_share": 50}])
def test_negatives_equal_brute_force(spark, settings):
    rows = clustered()
    got, anchors = mined(spark, rows, **settings)
    wanted = {"positives": 5, "negatives": 5, "least_share": 80, **settings}
    assert got == brute.hard_negatives(rows, anchors, wanted["positives"], wanted["negatives"], wanted["least_share"])
    assert len(got) > 50


def test_small_blocks_of_a_few_rows(spark, monkeypatch):
    monkeypatch.setattr(bond_scan, "BLOCK", 16)
    rows = clustered(seed=4)
    got, anchors = mined(spark, rows)
    assert got == brute.hard_negatives(rows, anchors)


@pytest.mark.parametrize("scale", [3, 10**5, 10**9, 10**17])
def test_scores_are_exact_whatever_their_size(spark, scale):
    rows = [(i, x, [y * scale for y in v]) for i, x, v in clustered(200, 12, scale=9, seed=2)]
    got, anchors = mined(spark, rows)
    assert got == brute.hard_negatives(rows, anchors) and got


def test_ties_copies_and_repeated_rows(spark):
    rows = [(i, i % 2, [3, 4, 0]) for i in range(300)] + [(7, 1, [3, 4, 0])] * 50 + [(10, 0, [3, 4, 0])] * 3
    got, anchors = mined(spark, rows, every=100)
    assert got == brute.hard_negatives(rows, anchors)
    assert [r[3] for r in got if r[0] == 0][:5] == [1, 3, 5, 7, 7]


def test_labels_alone_other_dimensions_and_no_vectors(spark):
    rows = [(0, 5, [1, 2]), (10, 1, [1, 2]), (11, 1, [2, 2]), (12, 2, [2, 1]), (13, 1, [9]), (14, 2, [8, 8, 8]), (20, 1, []), (21, 1, []), (22, 2, []), (30, 1, [-5, -5]), (31, 1, [1, 1]), (32, 2, [0, 1])]
    got, anchors = mined(spark, rows)
    assert got == brute.hard_negatives(rows, anchors)
    assert not [r for r in got if r[0] == 0] and (20, 21, 1, 22, 0, 0) in got and not [r for r in got if r[0] == 30 and r[4] < 0]
    empty = spark.createDataFrame([], _VECTORS)
    assert bond_scan.mine(empty, empty).count() == 0
    table = spark.createDataFrame(rows, _VECTORS)
    assert bond_scan.mine(table, empty).count() == 0


def test_rows_with_anything_missing_take_no_part(spark):
    rows = [(1, 1, [0.5, -0.01]), (None, 1, [1.0, 1.0]), (2, None, [1.0, 1.0]), (3, 1, None), (4, 1, [1.0, None]), (5, 1, [float("nan"), 1.0]), (6, 1, [float("inf"), 1.0]), (7, 1, [-float("inf"), 1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").withColumns({c: F.lit(c) for c in ("anchor", "slot", "score", "vector", "pack")})
    got = bond_scan.whole_vectors(table, scale=256).collect()
    assert [(r.vec_id, r.label, r.vector) for r in got] == [(1, 1, [128, -3])]


def test_the_scan_reads_few_columns_of_most_rows():
    """Rows leave the bitmap long before the last column where scores differ."""
    rng = np.random.default_rng(3)
    points = np.floor(rng.normal(0, 60, (64, 4000)) * (0.9 ** np.arange(64))[:, None]).astype(np.int32)
    row = {"vec_ids": np.arange(4000).tobytes(), "labels": np.zeros(4000, np.int64).tobytes(), "width": 4, "n": 4000, "columns": [c.tobytes() for c in points], "lows": points.min(1).tolist(), "highs": points.max(1).tolist()}
    block, read = bond_scan.Block(row), []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple):
                read.append(len(key[0]) * len(key[1]))
            return np.asarray(self)[key]

    block._as[np.float32] = points.astype(np.float32).view(Counted)
    query = points[:, 17].astype(np.int64)
    rows, scores = bond_scan.resolve(block, query, np.arange(4000), [(bond_scan._LONG.min, bond_scan._LONG.max)], 5)
    exact = query @ points.astype(np.int64)
    best = np.lexsort((np.arange(4000), -exact))[:5]
    assert set(best) <= set(rows.tolist()) and (exact[rows] == scores).all()
    assert sum(read) < 64 * 4000 / 2
