"""Near-duplicate groups by min-max hashing, banding and exact confirmation.

A document is the set of its distinct ``width``-word shingles.  Under each of
``PERMUTATIONS`` hash functions both the smallest and the largest value are
kept, so 64 evaluations give 128 signature values; they are cut into bands of
``ROWS`` values.  Two documents at the similarity bound share no band with
probability (1 - 0.8^4)^32 < 1e-7.

Equal sets are one class, represented by the smallest doc_id, before anything
is compared.  Inside a band's bucket pairs are not enumerated.  First every
member is compared with the bucket's smallest; then, in buckets that still
hold several components, with a few random members; and only what is still
apart after that is compared with the rest of its bucket, if sizes and
one-bit sketches allow the similarity at all.  So no link is lost: two members
of a bucket are either connected by confirmed links or were compared.  Each
link is confirmed on the full shingle sets, which are made again from the
texts of the candidates.

Defined results: A-Z is lower-cased; a text of fewer words, but not none, is
one shingle; an empty or null text has an empty set and is linked with
nothing; rows with a null doc_id have a null component and are kept, and link
nothing; repeated rows are in the same class; other columns are ignored.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lifeline.llm.components import components
from lifeline.llm.tables import maybe_broadcast, save

PERMUTATIONS = 64
ROWS = 4
BANDS = 2 * PERMUTATIONS // ROWS
#: Random members that each member of an unresolved bucket is compared with before the exhaustive pass.
STAR_ROUNDS = 2
#: Four bits of each signature value make a sketch.  Differing values of 128 beyond which a pair is not
#: confirmed: at similarity 0.8, 24 are expected, with a deviation of 4.4.
SKETCH_APART = 51
_SKETCH = 2 * PERMUTATIONS // 16

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)
_rng = np.random.default_rng(20240131)
_MUL = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.int64).view(np.uint64)
_BAND = _rng.integers(0, 2**63, (BANDS, ROWS), dtype=np.int64).view(np.uint64) | np.uint64(1)


class _WordHash(dict):
    """64-bit hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, width: int, words: _WordHash) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    # bytes.split() parts at exactly 0x20 and 0x09-0x0D
    parts = text.encode("utf-8", "replace").translate(_LOWER).split() if text else []
    if not parts:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter(map(words.__getitem__, parts), dtype=np.uint64, count=len(parts))
    n = min(width, len(w))
    h = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        h = (h + w[k : len(w) - n + 1 + k]) * _MIX
        h ^= h >> _SHIFT
    return np.unique(h)


def signature(sets: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of the set under each permutation."""
    low = np.full(PERMUTATIONS, 2**32 - 1, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for at in range(0, len(sets), 2048):
        x = sets[None, at : at + 2048] * _MUL[:, None]
        x += _ADD[:, None]
        x >>= np.uint64(32)
        np.minimum(low, x.min(axis=1), out=low)
        np.maximum(high, x.max(axis=1), out=high)
    return np.concatenate((low, high))


def _sign(width: int):
    def run(batches):
        words = _WordHash()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                sets = [shingles(t, width, words) for t in part.column("text").to_pylist()]
                sig = np.array([signature(s) for s in sets], dtype=np.uint64).reshape(-1, 2 * PERMUTATIONS)
                keys = ((sig.reshape(-1, BANDS, ROWS) + np.uint64(1)) * _BAND[None]).sum(axis=2, dtype=np.uint64)
                keys ^= keys >> _SHIFT
                keys = (keys * _MIX).view(np.int64)
                # a value's bit must not be that of its rank: mixed before it is taken
                bits = ((sig * _MIX) >> np.uint64(40) & np.uint64(15)).astype(np.uint8)
                bits = np.ascontiguousarray(bits[:, ::2] << 4 | bits[:, 1::2]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array(list(keys), pa.list_(pa.int64())),
                        pa.array(list(bits), pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "set_hash", "bands", "bits"],
                )

    return run


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(width: int, percent: int):
    def run(batches):
        words, recent = _WordHash(), OrderedDict()

        def of(node, text):
            if (node, text) in recent:
                recent.move_to_end((node, text))
            else:
                recent[node, text] = shingles(text, width, words)
                if len(recent) > 64:
                    recent.popitem(last=False)
            return recent[node, text]

        for b in batches:
            keep = [
                _similar(of(x, tx), of(y, ty), percent)
                for x, y, tx, ty in zip(*(b.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True)
            ]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(node, text) of the candidates, one row for each node and text."""
    ids = save(ids, "dedup-ids")
    rows = docs.where("doc_id is not null and text is not null")
    rows = rows.join(maybe_broadcast(ids, ids.count()), rows.doc_id == ids.node, "left_semi")
    rows = rows.select(F.col("doc_id").alias("node"), "text")
    again = save(docs.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("node")), "dedup-again")
    if n := again.count():
        mark = maybe_broadcast(again, n)
        rows = rows.join(mark, "node", "left_anti").union(rows.join(mark, "node", "left_semi").distinct())
    return save(rows, "dedup-texts")


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    a = nodes.select(*(F.col(c).alias(f"{c}_a") for c in nodes.columns))
    b = nodes.select(*(F.col(c).alias(f"{c}_b") for c in nodes.columns))
    pairs = (
        pairs.join(a, pairs.a == a.node_a).join(b, pairs.b == b.node_b).where(_possible("_a", "_b", percent)).select("a", "b").distinct()
    )
    ta = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    tb = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return save(pairs.join(ta, "a").join(tb, "b").mapInArrow(_confirm(width, percent), "a bigint, b bigint"), "dedup-links")


def _possible(x: str, y: str, percent: int) -> F.Column:
    """Sizes and sketches allow the similarity."""
    n, m = F.col(f"n{x}"), F.col(f"n{y}")

    def differing(k: int) -> F.Column:
        d = F.get(f"bits{x}", F.lit(k)).bitwiseXOR(F.get(f"bits{y}", F.lit(k)))
        for step in (1, 2):  # into the lowest of each four bits
            d = d.bitwiseOR(F.shiftrightunsigned(d, step))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (sum(differing(k) for k in range(_SKETCH)) <= SKETCH_APART)


def groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``:
    documents are linked when 100 * intersection >= ``percent`` * union (80 or
    more) of their shingle sets; ``component_id`` is the smallest doc_id reachable."""
    if percent < 80:
        raise ValueError("the bands are laid out for a similarity of 0.8 or more")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = save(
        docs.mapInArrow(
            _sign(width),
            "doc_id bigint, n_shingles bigint, set_hash binary, bands array<bigint>, bits array<bigint>",
        ),
        "dedup-signed",
    )
    classes = save(
        signed.where("doc_id is not null and set_hash is not null")
        .groupBy("set_hash")
        .agg(
            F.min("doc_id").alias("node"),
            F.any_value("n_shingles").alias("n"),
            F.any_value("bits").alias("bits"),
            F.any_value("bands").alias("bands"),
        ),
        "dedup-classes",
    )
    nodes = classes.select("node", "n", "bits")
    banded = classes.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi").select("band", "lo")
    members = save(banded.join(shared, "band"), "dedup-members")
    texts = _texts(docs, members.select("node").distinct())
    confirm = lambda pairs: _links(pairs, nodes, texts, width, percent)

    links = confirm(members.where("node != lo").select(F.col("node").alias("a"), F.col("lo").alias("b")).distinct())
    labels = components(links)
    for k in range(STAR_ROUNDS + 1):
        placed = members.select("band", "node").join(labels, "node", "left").select(
            "band", "node", F.coalesce("label", "node").alias("comp")
        )
        mixed = placed.groupBy("band").agg(
            F.min("comp").alias("lo"),
            F.max("comp").alias("hi"),
            F.min(F.struct(F.xxhash64("node", F.lit(k)), "node", "comp")).alias("rep"),
        ).where("lo != hi")
        placed = save(placed.join(mixed.select("band", "rep.node", "rep.comp").toDF("band", "rep", "rep_comp"), "band"), "dedup-mixed")
        if not placed.limit(1).count():
            break
        if k < STAR_ROUNDS:
            links = links.union(confirm(placed.where("comp != rep_comp").select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct()))
        else:
            links = links.union(save(_across(placed.select("band", "node", "comp"), classes, texts, width, percent), "dedup-links"))
        labels = components(links)

    smallest = labels.groupBy("label").agg(F.min("node").alias("component_id"))
    reached = labels.join(smallest, "label").select("node", "component_id")
    of_class = classes.select("set_hash", "node").join(reached, "node", "left").select(
        "set_hash", F.coalesce("component_id", "node").alias("component_id")
    )
    out = signed.select("doc_id", "n_shingles", "set_hash").join(of_class, "set_hash", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def _sets(width: int):
    def run(batches):
        words = _WordHash()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                sets = [shingles(t, width, words).view(np.int64) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("comp"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "comp", "shingles"]
                )

    return run


def _across(placed: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The links (a, b) between different components in the same bucket; at
    least one of a pair is outside the bucket's largest component.

    ``m`` counts the shingles of a node that occur in another component too;
    the intersection of a pair across components is no larger than either's.
    Pairs that pass this, the sizes and the sketches are confirmed on their
    full sets as part of the join, so only links leave it."""
    inside = placed.select("node", "comp").distinct().join(texts, "node")
    inside = save(inside.mapInArrow(_sets(width), "node bigint, comp bigint, shingles array<bigint>"), "dedup-sets")
    each = inside.select("node", "comp", F.explode("shingles").alias("shingle"))
    crossing = each.groupBy("shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("shingle")
    m = each.join(crossing, "shingle").groupBy("node").agg(F.count("*").alias("m"))
    # alone, an intersection of m allows 100 * m >= percent * n
    alive = classes.select("node", "n", "bits", "bands").join(m, "node").where(F.col("m") * 100 >= F.col("n") * percent)
    rest = placed.join(save(alive.join(inside.select("node", "shingles"), "node"), "dedup-alive"), "node")
    counts = rest.groupBy("band", "comp").count()
    largest = counts.groupBy("band").agg(F.max(F.struct("count", "comp"))["comp"].alias("most"))
    cols = ("node", "comp", "n", "m", "bits", "bands", "shingles")
    rich = rest.join(largest, "band").select("band", "most", *cols)
    left = rich.where("comp != most").select("band", *(F.col(c).alias(f"{c}_a") for c in cols))
    right = rich.select(F.col("band").alias("band_b"), *(F.col(c).alias(f"{c}_b") for c in ("most", *cols)))
    # of sets with n and k elements, (n + k) * percent / (100 + percent) have to be in both
    enough = lambda both, n, k: both * (100 + percent) >= (n + k) * percent
    return left.join(
        right,
        (F.col("band") == F.col("band_b"))
        & (F.col("comp_a") != F.col("comp_b"))
        & ((F.col("comp_b") == F.col("most_b")) | (F.col("node_a") < F.col("node_b")))
        & enough(F.least("m_a", "m_b"), F.col("n_a"), F.col("n_b"))
        & _possible("_a", "_b", percent)
        # a pair that shares several bands is compared in the first of them
        & (F.array_min(F.array_intersect("bands_a", "bands_b")) == F.col("band"))
        & enough(F.size(F.array_intersect("shingles_a", "shingles_b")), F.size("shingles_a"), F.size("shingles_b")),
    ).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, same columns.

    A document is a doc_id and a text: rows that are equal in both fold into the
    one whose columns, as JSON, sort first; different texts with the same doc_id
    are documents of their own, and all stay if nothing links them.  Of a group
    the smallest doc_id stays, where a repeated doc_id counts as itself for the
    text with the smallest sha256 and as beyond all others for the rest.  Empty
    texts and null doc_ids all stay.
    """
    ids = docs.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.count(F.lit(1)).alias("n"))
    repeated = save(ids.where("n > 1 and __id is not null").select("__id"), "dedup-repeated")
    mark, name = maybe_broadcast(repeated, repeated.count()), F.col("doc_id").cast("long")
    single, several = docs.join(mark, name == F.col("__id"), "left_anti"), docs.join(mark, name == F.col("__id"), "left_semi")

    # of a repeated id all documents but one are numbered from beyond the other ids
    said, first = F.sha2(F.coalesce(F.concat(F.lit("+"), "text"), F.lit("")).cast("binary"), 256), "__row"
    in_order = Window.partitionBy("doc_id", said).orderBy(F.to_json(F.struct(*docs.columns)))
    several = several.withColumn(first, F.row_number().over(in_order)).where(F.col(first) == 1).drop(first)
    beyond = (docs.agg(F.max(name)).first()[0] or 0) + 1
    keys = save(several.select(name.alias("__id"), said.alias("__said"), "text", F.monotonically_increasing_id().alias("__nth")), "dedup-keys")
    least = keys.groupBy(F.col("__id").alias("__least_id")).agg(F.min("__said").alias("__least_said"))
    keys = keys.join(least, (F.col("__id") == F.col("__least_id")) & (F.col("__said") == F.col("__least_said")), "left")
    keys = keys.withColumn("__key", F.coalesce("__least_id", F.lit(beyond) + F.col("__nth")))

    judged = save(
        groups(single.select("doc_id", "text").unionByName(keys.select(F.col("__key").alias("doc_id"), "text")), width, percent), "dedup-groups"
    )
    gone = save(judged.where("not kept").select(F.col("doc_id").alias("__gone")), "dedup-gone")
    mark = maybe_broadcast(gone, gone.count())
    out = single.join(mark, name == F.col("__gone"), "left_anti").select(docs.columns)
    lost = keys.join(gone, keys["__key"] == gone["__gone"], "left_semi").select("__id", "__said")
    return out.unionByName(several.join(lost, (name == F.col("__id")) & (said == F.col("__said")), "left_anti").select(docs.columns))
