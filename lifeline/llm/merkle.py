"""Merkle manifest of a document table: a tree per source, and one over the sources.

Layout below ``out`` (all written and read by Spark):

``leaves/level=0``, ``leaves/level=4``, ...   nodes (key, index, digest) of every
                 ``EVERY``-th level of the sources' trees; level 0 also has doc_id
                 and, if given, claim
``leaves/trees``   (key, n, depth) of each tree
``sources/...``    the same of the tree whose leaves are the sources' roots

Checkpoint and recompute: only those levels are stored.  A block of
``ARITY ** EVERY`` aligned nodes of a stored level holds all descendants, at
that level, of one node of the next; proofs rebuild the levels between from the
block, emit each node's siblings and drop them.  Building and proving group rows
by (key, block), so the largest source is spread like the others, and the upper
part of a proof is joined once per block.

Leaves of a source are in ascending order of doc_id (null first), those with the
same doc_id in order of their digest.  Every ``ARITY`` consecutive nodes (the
last run may be shorter, even a single node) become the hash of their digests
until one is left; a lone leaf is its own root.

Defined results: null fields are hashed as ``-``; equal rows are leaves of
their own; a null source is a source; an empty table has no rows and no root;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeline.llm.tables import maybe_broadcast, sha256_hex
from lifeline.operators.numbering import number_in_groups

ARITY = 3
#: Levels from one stored level to the next.
EVERY = 4
BLOCK = ARITY**EVERY
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PROOF = "array<struct<left:string,right:string>>"


def leaf_digest(**changed: Column) -> Column:
    """The leaf of a row; ``changed`` replaces fields by other columns."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return sha256_hex(F.concat(*parts))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` leads to by the siblings of ``proof``."""
    return F.aggregate(proof, leaf, lambda node, run: sha256_hex(F.concat(run["left"], node, run["right"])))


def proof_digest(proof: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return sha256_hex(F.array_join(F.transform(proof, lambda run: F.concat(run["left"], run["right"])), ""))


def _key(source: Column) -> Column:
    """A source as a string that is never null and sorts nulls first."""
    return F.coalesce(F.concat(F.lit("+"), source), F.lit(""))


def _depth(n: Column) -> Column:
    """Levels above ``n`` leaves."""
    return F.size(F.filter(F.lit([ARITY**k for k in range(40)]), lambda p: p < n))


def _level_up(nodes: Column) -> Column:
    last = F.floor((F.size(nodes) - 1) / ARITY).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: sha256_hex(F.array_join(F.slice(nodes, k * ARITY + 1, F.lit(ARITY)), "")))


def _blocks(nodes: DataFrame, trees: DataFrame, level: int) -> DataFrame:
    """(key, block, items, levels, at_0 .. at_EVERY): the blocks of a stored
    level and the levels rebuilt above each; ``levels`` are those the tree has."""
    kept = [c for c in nodes.columns if c not in ("key", "index")]
    rows = nodes.groupBy("key", F.expr(f"index div {BLOCK}").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("index", *kept))).alias("items")
    )
    rows = rows.join(trees.select("key", F.least(F.lit(EVERY), F.greatest(F.col("depth") - level, F.lit(0))).alias("levels")), "key")
    rows = rows.withColumn("at_0", F.transform("items", lambda x: x["digest"]))
    for k in range(EVERY):
        at = F.col(f"at_{k}")
        rows = rows.withColumn(f"at_{k + 1}", F.when(F.col("levels") > k, _level_up(at)).otherwise(at))
    return rows


def _trees(spark: SparkSession, path: str) -> DataFrame:
    trees = spark.read.parquet(f"{path}/trees")
    return maybe_broadcast(trees, trees.count())


def _stored(trees: DataFrame) -> range:
    """Stored levels above which a tree goes on."""
    deepest = trees.agg(F.max("depth")).first()[0] or 0
    return range(0, deepest, EVERY)


def _build(nodes: DataFrame, path: str) -> DataFrame:
    """Write the trees of ``nodes`` (key, index, digest, ...); returns (key, n,
    depth, digest) of each root."""
    spark = nodes.sparkSession
    nodes.write.parquet(f"{path}/level=0")
    nodes = spark.read.parquet(f"{path}/level=0")
    nodes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("depth", _depth(F.col("n"))).write.parquet(f"{path}/trees")
    trees, top = _trees(spark, path), 0
    for level in _stored(trees):
        top = level + EVERY
        up = _blocks(spark.read.parquet(f"{path}/level={level}").select("key", "index", "digest"), trees, level)
        up.select("key", F.col("block").alias("index"), F.get(f"at_{EVERY}", F.lit(0)).alias("digest")).write.parquet(f"{path}/level={top}")
    return spark.read.parquet(f"{path}/level={top}").select("key", "digest").join(trees, "key")


def write(docs: DataFrame, out: str, claim: Column | None = None) -> None:
    """Write the manifest of ``docs`` below ``out``.  ``claim``, a leaf digest
    computed from a later state of the same row, is stored beside its leaf."""
    leaves = docs.select(
        _key(F.col("source")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest().alias("digest"),
        *([claim.alias("claim")] if claim is not None else []),
    )
    leaves = number_in_groups(leaves, "key", ["doc_id", "digest"], "pos")
    roots = _build(leaves.withColumn("index", F.col("pos") - 1).drop("pos"), f"{out}/leaves")
    sources = roots.select(F.lit("").alias("tree"), F.col("key").alias("source_key"), "digest")
    sources = number_in_groups(sources, "tree", ["source_key"], "pos")
    _build(sources.select(F.col("tree").alias("key"), (F.col("pos") - 1).alias("index"), "digest", "source_key"), f"{out}/sources")


def _siblings(place: Column) -> Column:
    """The part of a proof inside a block, for the node at ``place`` of its lowest level."""
    parts = []
    for k in range(EVERY):
        nodes, at = F.col(f"at_{k}"), F.floor(place / ARITY**k).cast("int")
        inside = at % ARITY
        left = F.array_join(F.slice(nodes, at - inside + 1, inside), "")
        right = F.array_join(F.slice(nodes, at + 2, ARITY - 1 - inside), "")
        parts.append(F.when(F.col("levels") > k, F.struct(left.alias("left"), right.alias("right"))))
    return F.array_compact(F.array(*parts))


def _proved(own: list[str]) -> Column:
    """A block's items, with fields ``own``, and their proofs."""
    proof = lambda place: F.concat(_siblings(place), F.col("proof")).cast(_PROOF)
    return F.transform("items", lambda item, place: F.struct(*(item[c].alias(c) for c in own), proof(place).alias("proof")))


def _prove(spark: SparkSession, path: str, tops: DataFrame) -> DataFrame:
    """The leaves below ``path`` with their proofs; ``tops`` (key, proof, ...) has
    the part above each tree, and columns that every leaf of it gets."""
    trees = _trees(spark, path)
    carried = [c for c in tops.columns if c not in ("key", "proof")]
    up, levels = tops.withColumn("index", F.lit(0).cast("long")), _stored(trees)
    if not levels:
        return spark.read.parquet(f"{path}/level=0").join(up, ["key", "index"])
    for level in reversed(levels):
        nodes = spark.read.parquet(f"{path}/level={level}")
        rows = _blocks(nodes, trees, level).join(up.withColumnRenamed("index", "block"), ["key", "block"])
        up = rows.select("key", *carried, F.inline(_proved([c for c in nodes.columns if c != "key"])))
        if level:
            up = up.drop("digest")
    return up


def proofs(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, leaf, claim if stored, subroot, root, proof) of every leaf."""
    trees = spark.read.parquet(f"{out}/sources/trees")
    top = len(_stored(trees)) * EVERY
    root = spark.read.parquet(f"{out}/sources/level={top}").select("key", F.col("digest").alias("root"))
    tops = root.select("key", F.array().cast(_PROOF).alias("proof"), "root")
    sources = _prove(spark, f"{out}/sources", tops)
    sources = sources.select(F.col("source_key").alias("key"), F.col("digest").alias("subroot"), "root", "proof")
    out = _prove(spark, f"{out}/leaves", sources).withColumnRenamed("digest", "leaf")
    return out.select("doc_id", "leaf", *(c for c in ["claim"] if c in out.columns), "subroot", "root", "proof")


def verdicts(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): every
    row's claim (else its leaf) folded with the stored siblings."""
    rows = proofs(spark, out)
    now = F.col("claim") if "claim" in rows.columns else F.col("leaf")
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), fold(now, F.col("proof")).alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
