"""Mined negatives against a scan of all pairs."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lifeline.llm import hard_negatives as H
from lifeline.llm.queries import op11_hard_negatives

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every=100, relabel=True):
    """(vec_id, vector, label) rows -> sorted result rows."""
    used = []
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if relabel and vec_id % 7 == 0 else label
        used.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for i, (anchor, label, v) in enumerate(used):
        if anchor % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j, k) for k, (j, _, w) in enumerate(used) if k != i)
        best = [(-s, j) for s, j, k in scored if used[k][1] == label][:5]
        others = [(-s, j) for s, j, k in scored if used[k][1] != label]
        for p, positive in best:
            kept = [(s, j) for s, j in others if 30 * p <= 100 * s <= 90 * p][:10]
            out += [(anchor, positive, r + 1, j, p, s) for r, (s, j) in enumerate(kept)]
    return sorted(out)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _mine(spark, rows, every=100, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("cell", F.lit("clash")).withColumn("shelf", F.lit(0))
    return H.mine(frame, F.col("vec_id") % every == 0, **options)


def test_the_query(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet")
    rows = list(zip(*(table.column(c).to_pylist() for c in ("vec_id", "embedding", "label")), strict=True))
    got = op11_hard_negatives(spark, SF)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    assert _rows(got) == brute(rows)


def _clouds(n, width, centres, spread, seed, labels=4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, width))
    at = rng.integers(centres, size=n)
    x = (middle[at] + spread * rng.normal(size=(n, width))).astype(np.float32)
    return [(k, v.tolist(), int(rng.integers(labels))) for k, v in enumerate(x)]


@pytest.fixture(autouse=True)
def small_rounds(monkeypatch):
    monkeypatch.setattr(H, "FIRST_ROWS", 100)


@pytest.mark.parametrize("width,spread", [(8, 0.05), (5, 0.5), (1, 1.0)])
def test_clouds_in_many_rounds_blocks_and_shelves(spark, width, spread):
    rows = _clouds(700, width, 12, spread, 3)
    assert _rows(_mine(spark, rows, 20, anchor_block=15, shelf_rows=40)) == brute(rows, 20, relabel=False)


def test_a_vector_that_a_third_of_all_rows_have(spark):
    rows = _clouds(400, 6, 5, 0.3, 4)
    rows = [(k, rows[0][1] if k % 3 == 0 else v, k % 2) for k, v, _ in rows]
    assert _rows(_mine(spark, rows, 25, shelf_rows=20)) == brute(rows, 25, relabel=False)


def test_rows_out_of_line(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [float(k % 5) - 2, 1.0, 0.5], k % 2) for k in range(60)]
    rows += [(None, [1.0, 1.0, 1.0], 0), (100, None, 0), (200, [1.0, None, 1.0], 0), (300, [nan, 1.0, 1.0], 0), (400, [inf, 1.0, 1.0], 0)]
    rows += [(500, [1.0, 2.0, 3.0], None), (600, [], 0), (700, [2.0], 1), (800, [0.0, 0.0, 0.0], 1), (900, [-1.0, -3.0, 2.0], 7), (20, [1.0, 1.0, 0.5], 0), (20, [1.0, 1.0, 0.5], 0)]
    assert _rows(_mine(spark, rows, 20)) == brute(rows, 20, relabel=False)


def test_no_rows_no_anchors_one_row(spark):
    assert _mine(spark, []).count() == 0
    assert _mine(spark, [(1, [1.0], 0), (2, [1.0], 1)]).count() == 0
    assert _mine(spark, [(100, [1.0], 0)]).count() == 0
    assert _mine(spark, [(100, None, 0)]).count() == 0


def test_certified_windows_leave_cells_unvisited(spark):
    """Bounds hold for all rows, cells come in falling order, and far cells are not visited."""
    rows = _clouds(900, 8, 10, 0.02, 5)
    table = H.integer_rows(spark.createDataFrame(rows, SCHEMA), "embedding").cache()
    index, cells = H.build_index(table)
    assert index.count() == 900 == cells.count.sum()
    held = {}
    for r in index.collect():
        held.setdefault(r["cell"], []).append(r["v"])
    anchor = np.array(held[max(held)][0], dtype=float)
    order = list(cells.in_order(anchor))
    assert [m for m, _, _ in order] == sorted((m for m, _, _ in order), reverse=True)
    assert len({c for _, _, c in order}) == len(order) and {c for _, _, c in order} >= set(held)
    for most, least, cell in order:
        for v in held.get(cell, []):
            assert least <= anchor @ np.array(v) <= most
    full = max(anchor @ np.array(v) for v in held[max(held)])
    _, visited = cells.next_cells(anchor, 0, [int(0.9 * full)], [int(full)], 10**9)
    assert max(held) in visited and sum(len(held[c]) for c in visited) < 450


def test_shelves_share_and_split():
    stats = [(k, n, 1.0, 1.0) for k, n in enumerate([5, 5, 25, 0, 3, 9, 1])]
    cells = H.Cells((np.zeros((7, 1)), np.zeros((1, 1))), stats, 10)
    assert cells.first.tolist()[:3] == [0, 0, 1] and cells.shelves.tolist() == [1, 1, 3, 1, 1, 1, 1]
    assert cells.first.tolist()[4:] == [4, 5, 5]


def test_scores_beyond_doubles(spark):
    rng = random.Random(2)
    rows = [(k, [rng.uniform(-16000, 16000) for _ in range(80)], k % 3) for k in range(120)]
    assert _rows(_mine(spark, rows, 10)) == brute(rows, 10, relabel=False)
