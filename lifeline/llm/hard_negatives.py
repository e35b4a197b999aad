"""Hard negatives by an inverted multi-index, exact by certified windows.

1. Vectors become integers, ``floor(SCALE * x)``.  Two codebooks of ``CODES``
   centroids, one for each half of the components, are fitted on a bounded
   sample (``SAMPLE_ROWS`` rows picked by hash); they make ``CODES ** 2`` cells.
   Every row is put into its cell.  Radii (the largest distance of a half from
   its centroid) and row counts are taken over all rows.
2. Cells are laid out on shelves of about equally many rows: small cells share
   one, a large cell gets several.  The index is written once, bucketed by
   shelf, and does not move again.
3. An anchor visits cells in the order of the greatest score that they can hold:
   the sum, over both halves, of the centroid's score plus the radius times the
   anchor's length.  A heap over the two sorted lists of half bounds yields that
   order without listing all cells (multi-sequence search).
4. Each round visits the next cells of every open anchor, ``GROWTH`` times as many
   rows as the round before; a shelf scores the anchors that visit it as one
   matrix product and sends on the best few.  An anchor is finished when no
   window can change: the next bound is below the window, or below its last kept
   score once it is full.  Cells whose least score is above all windows are passed
   over.  So results are those of a full scan, and only the work depends on the data.

Positives (the best ``POSITIVES`` other rows of the anchor's label) are searched
first; each opens a window of scores for rows of other labels.  Anchors go
through in blocks of ``ANCHOR_BLOCK``, which bounds what a shelf's task holds.

Defined results: rows with a null id, label or vector, with a null or non-finite
component, or with one of ``LARGEST`` or more after scaling take no part; a shorter
vector counts as filled up with zeros; equal rows are rows of their own, and a
row is never its own positive; an anchor without positives gives no rows, nor
does an empty window (a positive's score below zero); other columns are ignored.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lifeline.llm.tables import hashed_sample, save, save_bucketed

SCALE = 256
#: Scaled components are smaller, so that scores and their hundredfold fit 64 bits.
LARGEST = 1 << 22
#: Centroids of each codebook, and rows and rounds they are fitted with.
CODES = 16
SAMPLE_ROWS = 8_192
FIT_ROUNDS = 10
#: Rows of a shelf, at most (about) and at least.
SHELF_ROWS = 1 << 18
MIN_SHELF_ROWS = 64
#: Rows that an anchor's first round visits; each round visits GROWTH times as many.
FIRST_ROWS = 4_096
GROWTH = 8
#: Anchors that are searched at a time, and that a matrix product takes.
ANCHOR_BLOCK = 200_000
ANCHORS_AT_ONCE, ROWS_AT_ONCE = 64, 1 << 14
POSITIVES, NEGATIVES = 5, 10
#: A negative's score, in hundredths of its positive's.
LOW, HIGH = 30, 90
_MOST = 1 << 62

_WANTS = "array<struct<same:boolean,low:bigint,high:bigint>>"
_FOUND = "array<struct<want:int,neg:bigint,id:bigint>>"
_STATE = f"rid bigint, vec_id bigint, label bigint, v array<int>, positives {_FOUND}, wants {_WANTS}, found {_FOUND}, place int"
_PLAN = f"{_STATE}, floors array<bigint>, shelves array<struct<shelf:int,cells:array<int>>>"
_HIT = "rid bigint, want int, neg bigint, id bigint"


def integer_rows(rows: DataFrame, vector: str) -> DataFrame:
    """(rid, vec_id, label, v) of the rows that take part; rid numbers rows."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST / SCALE, F.lit(False)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)
    rows = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("int")).alias("v"),
    )
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    filled = F.concat("v", F.array_repeat(F.lit(0), F.lit(width) - F.size("v")))
    return rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", filled.alias("v"))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column))).astype(np.float64)


def fit_codebook(points: np.ndarray) -> np.ndarray:
    """Centroids of ``points`` by Lloyd's rounds from evenly spaced distinct points."""
    distinct = np.unique(points, axis=0)
    if not len(distinct):
        return np.zeros((1, points.shape[1]))
    centres = distinct[np.unique(np.linspace(0, len(distinct) - 1, CODES).astype(int))]
    for _ in range(FIT_ROUNDS):
        code, _ = nearest(points, centres)
        centres = np.array([points[code == k].mean(axis=0) if (code == k).any() else c for k, c in enumerate(centres)])
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each point, and how far it is."""
    far = (centres**2).sum(axis=1) - 2 * points @ centres.T
    code = far.argmin(axis=1)
    return code, np.sqrt(((points - centres[code]) ** 2).sum(axis=1))


class Cells:
    """What every task knows of the index; bounded by the number of cells."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], stats, shelf_rows: int):
        n = [len(b) for b in books]
        self.books, self.count = books, np.zeros(n[0] * n[1], dtype=np.int64)
        self.radii = [np.full(k, -np.inf) for k in n]
        for cell, rows, *far in stats:
            self.count[cell] = rows
            for radii, code, r in zip(self.radii, divmod(cell, n[1]), far, strict=True):
                radii[code] = max(radii[code], r)
        # a cell's first shelf, and how many it has
        self.first, self.shelves = np.zeros(len(self.count), dtype=int), np.maximum(1, -(-self.count // shelf_rows))
        shelf, room = -1, 0
        for cell, rows in enumerate(self.count.tolist()):
            if self.shelves[cell] > 1 or rows > room:
                shelf, room = shelf + 1, shelf_rows
            self.first[cell] = shelf
            shelf, room = shelf + int(self.shelves[cell]) - 1, room - rows if self.shelves[cell] == 1 else 0

    def bounds(self, anchor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(most, least) score of the halves with each code; -inf where there are none."""
        half, out = self.books[0].shape[1], []
        for a, centres, radii in zip((anchor[:half], anchor[half:]), self.books, self.radii, strict=True):
            score, reach = centres @ a, np.linalg.norm(a) * radii
            slack = 1 + 1e-9 * np.linalg.norm(a) * (np.linalg.norm(centres, axis=1) + np.abs(radii))  # for rounding
            out.append((np.where(np.isfinite(radii), score + reach + slack, -np.inf), score - reach - slack))
        return out

    def in_order(self, anchor: np.ndarray):
        """(most, least, cell) of every cell that may have rows, by falling ``most``."""
        (most1, least1), (most2, least2) = self.bounds(anchor)
        by1, by2 = np.argsort(-most1, kind="stable"), np.argsort(-most2, kind="stable")
        n1, n2 = int(np.isfinite(most1).sum()), int(np.isfinite(most2).sum())
        heap = [(-(most1[by1[0]] + most2[by2[0]]), 0, 0)] if n1 and n2 else []
        while heap:
            bound, i, j = heapq.heappop(heap)
            a, b = by1[i], by2[j]
            yield -bound, least1[a] + least2[b], int(a) * len(most2) + int(b)
            if j + 1 < n2:
                heapq.heappush(heap, (-(most1[a] + most2[by2[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < n1:
                heapq.heappush(heap, (-(most1[by1[i + 1]] + most2[b]), i + 1, 0))

    def next_cells(self, anchor: np.ndarray, place: int, floors, highs, budget: int) -> tuple[int, list[int]]:
        """Cells that the anchor visits after its first ``place`` ones, until the
        windows are certified (the place is then past the end) or ``budget`` rows."""
        lowest = min(floors, default=_MOST)
        highest, out, rows = max(highs, default=-_MOST), [], 0
        for k, (most, least, cell) in enumerate(self.in_order(anchor)):
            if most < lowest:
                break
            if k < place or not self.count[cell] or least > highest:
                continue
            if rows >= budget:
                return k, out
            out.append(cell)
            rows += int(self.count[cell])
        return len(self.count), out


def build_index(rows: DataFrame, codes_sample: int = SAMPLE_ROWS, shelf_rows: int | None = None) -> tuple[DataFrame, Cells]:
    """The coded rows, bucketed by shelf, and what is known of the cells."""
    spark = rows.sparkSession
    sample = hashed_sample(rows, codes_sample, "vec_id", "rid").select("v").toArrow()
    points = _matrix(sample.column("v"))
    half = -(-points.shape[1] // 2)
    books = fit_codebook(points[:, :half]), fit_codebook(points[:, half:])

    def code(batches):
        for b in batches:
            x = _matrix(b.column("v"))
            (c1, far1), (c2, far2) = nearest(x[:, :half], books[0]), nearest(x[:, half:], books[1])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array((c1 * len(books[1]) + c2).astype(np.int32)), pa.array(far1), pa.array(far2)],
                names=[*b.schema.names, "cell", "far1", "far2"],
            )

    coded = save(
        rows.mapInArrow(code, "rid bigint, vec_id bigint, label bigint, v array<int>, cell int, far1 double, far2 double"), "negatives-coded"
    )
    stats = coded.groupBy("cell").agg(F.count(F.lit(1)), F.max("far1"), F.max("far2")).collect()
    if shelf_rows is None:
        even = sum(s[1] for s in stats) // int(spark.conf.get("spark.sql.shuffle.partitions"))
        shelf_rows = min(SHELF_ROWS, max(MIN_SHELF_ROWS, even))
    cells = Cells(books, stats, shelf_rows)
    first, many = (F.get(F.lit(x.tolist()), F.col("cell")) for x in (cells.first, cells.shelves))
    shelf = (first + F.pmod(F.xxhash64("rid"), many)).cast("int")
    return save_bucketed(coded.select("rid", "vec_id", "label", "v", "cell", shelf.alias("shelf")), "negatives-index", "shelf"), cells


def _plan(cells: Cells, keep: int, budget: int):
    """States with the shelves that each anchor visits in this round."""
    schema = pa.schema([("place", pa.int32()), ("floors", pa.list_(pa.int64())), ("shelves", pa.list_(pa.struct([("shelf", pa.int32()), ("cells", pa.list_(pa.int32()))])))])

    def run(batches):
        for b in batches:
            out, anchors = [], _matrix(b.column("v"))
            for anchor, place, wants, found in zip(anchors, *(b.column(c).to_pylist() for c in ("place", "wants", "found")), strict=True):
                kept = [[-f["neg"] for f in found if f["want"] == k] for k in range(len(wants))]
                floors = [k[-1] if len(k) == keep else w["low"] for k, w in zip(kept, wants, strict=True)]
                live = [(f, w["high"]) for f, w in zip(floors, wants, strict=True) if f <= w["high"]]
                place, visited = cells.next_cells(anchor, place, [f for f, _ in live], [h for _, h in live], budget)
                shelves: dict[int, list[int]] = {}
                for cell in visited:
                    for shelf in range(cells.first[cell], cells.first[cell] + cells.shelves[cell]):
                        shelves.setdefault(int(shelf), []).append(cell)
                out.append({"place": place, "floors": floors, "shelves": [{"shelf": s, "cells": c} for s, c in shelves.items()]})
            fresh = pa.RecordBatch.from_pylist(out, schema=schema)
            old = [n for n in b.schema.names if n != "place"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in old), *fresh.columns], names=[*old, *schema.names])

    return run


def _best(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, keep: int) -> np.ndarray:
    """Places of the best allowed scores, ties by smaller id."""
    at = np.flatnonzero(allowed)
    if len(at) > keep:
        s = scores[at]
        at = at[s >= np.partition(s, len(s) - keep)[len(s) - keep]]
    return at[np.lexsort((ids[at], -scores[at]))[:keep]]


def _score(n_cells: int, keep: int):
    """The best rows of a shelf for each window of the anchors that visit it."""

    def run(rows: pa.Table, visits: pa.Table) -> pa.Table:
        out = {"rid": [], "want": [], "neg": [], "id": []}
        x = _matrix(rows.column("v"))
        own, ids, labels, cells = (rows.column(c).to_numpy() for c in ("rid", "vec_id", "label", "cell"))
        for start in range(0, visits.num_rows if rows.num_rows else 0, ANCHORS_AT_ONCE):
            part = visits.slice(start, ANCHORS_AT_ONCE)
            anchors = _matrix(part.column("v"))
            seen = np.zeros((part.num_rows, n_cells), dtype=bool)
            for i, visited in enumerate(part.column("cells").to_pylist()):
                seen[i, visited] = True
            near = np.flatnonzero(seen.any(axis=0)[cells])
            big = np.abs(x).max(initial=0) * np.abs(anchors).max(initial=0) * max(1, x.shape[1]) >= 2**53
            a = anchors.astype(np.int64) if big else anchors
            each = part.select(["rid", "label", "wants", "floors"]).to_pylist()
            for first in range(0, len(near), ROWS_AT_ONCE):
                at = near[first : first + ROWS_AT_ONCE]
                scores = (a @ (x[at].astype(np.int64) if big else x[at]).T).astype(np.int64)
                for i, anchor in enumerate(each):
                    open_to = seen[i, cells[at]] & (own[at] != anchor["rid"])
                    same = labels[at] == anchor["label"]
                    for k, (want, floor) in enumerate(zip(anchor["wants"], anchor["floors"], strict=True)):
                        s = scores[i]
                        best = _best(s, ids[at], open_to & (same == want["same"]) & (s >= floor) & (s <= want["high"]), keep)
                        out["rid"] += [anchor["rid"]] * len(best)
                        out["want"] += [k] * len(best)
                        out["neg"] += (-s[best]).tolist()
                        out["id"] += ids[at][best].tolist()
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), kinds, strict=True)})

    return run


def _search(state: DataFrame, index: DataFrame, cells: Cells, keep: int) -> DataFrame:
    """``state`` with ``found``: the best ``keep`` rows of every window."""
    budget = FIRST_ROWS
    while True:
        planned = save(state.mapInArrow(_plan(cells, keep, budget), _PLAN), "negatives-plan")
        if not planned.where(F.size("shelves") > 0).limit(1).count():
            return planned.drop("floors", "shelves")
        visits = planned.select("rid", "label", "v", "wants", "floors", F.inline("shelves").alias("on_shelf", "cells"))
        hits = index.groupBy("shelf").cogroup(visits.groupBy("on_shelf")).applyInArrow(_score(len(cells.count), keep), _HIT)
        rows = hits.unionByName(planned.select("rid", F.inline("found")))
        order = Window.partitionBy("rid", "want").orderBy("neg", "id")
        rows = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= keep)
        best = rows.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("want", "neg", "id"))).alias("best"))
        state = planned.drop("floors", "shelves").join(best, "rid", "left")
        state = state.withColumn("found", F.coalesce("best", F.array().cast(_FOUND))).drop("best")
        state = save(state.select("rid", "vec_id", "label", "v", "positives", "wants", "found", "place"), "negatives-found")
        budget *= GROWTH


def _window(positive: Column) -> Column:
    """The scores of a positive's negatives; empty for a score below zero."""
    score = -positive["neg"]
    least = F.call_function("div", score * LOW + 99, F.lit(100))
    most = F.call_function("div", score * HIGH, F.lit(100))
    fits = score >= 0
    return F.struct(F.lit(False).alias("same"), F.when(fits, least).otherwise(1).alias("low"), F.when(fits, most).otherwise(0).alias("high"))


def mine(rows: DataFrame, anchors: Column, vector: str = "embedding", anchor_block: int = ANCHOR_BLOCK, shelf_rows: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    of the rows for which the condition ``anchors`` holds, against all rows."""
    spark: SparkSession = rows.sparkSession
    index, cells = build_index(save(integer_rows(rows, vector), "negatives-rows"), shelf_rows=shelf_rows)
    chosen = index.where(anchors).select("rid", "vec_id", "label", "v")
    blocks = -(-chosen.count() // anchor_block)
    none = F.array().cast(_FOUND)
    nearest_of_label = F.array(F.struct(F.lit(True).alias("same"), F.lit(-_MOST).alias("low"), F.lit(_MOST).alias("high"))).cast(_WANTS)
    parts = []
    for block in range(blocks):
        part = chosen.where(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == block)
        state = part.select("*", none.alias("positives"), nearest_of_label.alias("wants"), none.alias("found"), F.lit(0).alias("place"))
        state = _search(state, index, cells, POSITIVES)
        state = state.select(
            "rid", "vec_id", "label", "v", F.col("found").alias("positives"), F.transform("found", _window).cast(_WANTS).alias("wants"),
            none.alias("found"), F.lit(0).alias("place"),
        )
        parts.append(_search(state, index, cells, NEGATIVES))
    if not parts:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    state = reduce(DataFrame.unionByName, parts)
    each = F.transform("positives", lambda p, k: F.struct(p.alias("positive"), F.filter("found", lambda f: f["want"] == k).alias("negatives")))
    pairs = state.select(F.col("vec_id").alias("anchor_id"), F.inline(each))
    return pairs.select("anchor_id", "positive", F.posexplode("negatives").alias("nth", "negative")).select(
        "anchor_id",
        F.col("positive.id").alias("positive_id"),
        (F.col("nth") + 1).alias("rank"),
        F.col("negative.id").alias("negative_id"),
        (-F.col("positive.neg")).alias("positive_score"),
        (-F.col("negative.neg")).alias("negative_score"),
    )
