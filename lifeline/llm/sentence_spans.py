"""Substring dedup by sliding spans of sentences.

A text is cut into sentences (at ``. ! ?`` and line ends); a sentence of more
than ``LONG_WORDS`` words is cut further at words picked by their own hash
(the smallest of each window of ``WINDOW`` words), so that copies of a passage
are cut alike wherever they stand.  From every piece starts a span, the
shortest run of at least ``MIN_SENTENCES`` pieces and ``MIN_WORDS`` words, and
at every piece ends one, so that spans cover a repeated run to its last piece.
Spans are hashed and joined over the whole corpus; the first row that holds a
span keeps it, and pieces covered by a span that is not the first are removed.
Rows are in order of doc_id; those whose doc_id is null or stands in several rows
come after all others.  No piece of a long sentence has more than 12 words,
so a repeated passage, wherever it stands, loses at most 12 words at each end to
its neighbours; all whole pieces between go if they are a span, which they
always are from 44 words on.

Hot spans are pre-aggregated (smallest and largest doc_id per hash) before the
shuffle; what a document loses comes back grouped by document, which is
bounded by its length.

Defined results: a null text stays null and an empty one empty; a span
repeated inside one document stays once; of equal rows one keeps its text; all
rows and other columns are kept, and a document that is a copy as a whole becomes
empty.  A span is known by 64 bits of hash.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifeline.llm.tables import maybe_broadcast, save

MIN_SENTENCES = 2
MIN_WORDS = 20
LONG_WORDS = 12
WINDOW = 12

_PIECE = re.compile(r"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+")
_WORD = re.compile(r"\S+\s*")
_BASE = 0x9E3779B97F4A7C15
_MASK = 2**64 - 1


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as far as needed."""

    def __init__(self):
        self.up, self.down = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            step, back = pow(_BASE, len(self.up), 2**64), pow(pow(_BASE, -1, 2**64), len(self.up), 2**64)
            self.up = np.concatenate((self.up, self.up * np.uint64(step)))
            self.down = np.concatenate((self.down, self.down * np.uint64(back)))
        return self.up[:n], self.down[:n]


def _cuts(words: list[str]) -> list[int]:
    """Where the pieces of a long sentence start and end, by the words' own hashes."""
    h = [xxhash.xxh32_intdigest(w.lower()) for w in words]
    cuts, low = [0], -1
    for end in range(WINDOW, len(h) + 1):
        if low < end - WINDOW:
            window = h[end - WINDOW : end]
            low = end - WINDOW + window.index(min(window))
        elif h[end - 1] < h[low]:
            low = end - 1
        if cuts[-1] != low + 1:
            cuts.append(low + 1)
    return cuts if cuts[-1] == len(h) else [*cuts, len(h)]


def sentences(text: str | None) -> tuple[list[str], list[int], list[int]]:
    """Pieces that make up the text, with their word counts and hashes; a piece
    without words belongs to the one before it."""
    pieces, counts, hashes = [], [], []
    for piece in _PIECE.findall(text) if text else []:
        words = piece.split()
        if not words and pieces:
            pieces[-1] += piece
            continue
        if len(words) <= LONG_WORDS:
            pieces.append(piece)
            counts.append(len(words))
            hashes.append(xxhash.xxh3_64_intdigest(" ".join(words).lower()))
            continue
        cuts = _cuts(words)
        at = [m.start() for m in _WORD.finditer(piece)] + [len(piece)]
        at[0] = 0
        for s, e in zip(cuts, cuts[1:]):
            pieces.append(piece[at[s] : at[e]])
            counts.append(e - s)
            hashes.append(xxhash.xxh3_64_intdigest(" ".join(words[s:e]).lower()))
    return pieces, counts, hashes


def spans(counts: list[int], hashes: list[int], powers: _Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of the spans that start or end at each piece, as far
    as there are any."""
    n = len(counts)
    total = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    first = np.arange(n)
    end = np.maximum(np.searchsorted(total, total[:-1] + MIN_WORDS), first + MIN_SENTENCES)
    last = np.arange(1, n + 1)
    start = np.minimum(np.searchsorted(total, total[1:] - MIN_WORDS, side="right") - 1, last - MIN_SENTENCES)
    # a span that ends at a piece is new unless it is the one that starts where it does
    start, last = start[start >= 0], last[start >= 0]
    new = end[start] != last
    first, end = np.concatenate((first[end <= n], start[new])), np.concatenate((end[end <= n], last[new]))
    up, down = powers.upto(n + 1)
    prefix = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(np.array(hashes, dtype=np.uint64) * up[:n])))
    h = (prefix[end] - prefix[first]) * down[first]
    h ^= h >> np.uint64(31)
    return (h * np.uint64(_BASE)).view(np.int64), first, end


def _collect(batches):
    powers = _Powers()
    for b in batches:
        for at in range(0, b.num_rows, 512):
            part = b.slice(at, 512)
            ids, found = [], []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                _, counts, hashes = sentences(text)
                h = np.unique(spans(counts, hashes, powers)[0])
                ids.append(np.full(len(h), doc_id, dtype=np.int64))
                found.append(h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found)), pa.array(np.concatenate(ids))], names=["span", "doc_id"]
            )


def _clean_text(text: str | None, taken: set[int], powers: _Powers):
    """The text without covered sentences; sentences, removed sentences, removed words."""
    pieces, counts, hashes = sentences(text)
    h, first, end = spans(counts, hashes, powers)
    gone, seen = np.zeros(len(pieces), dtype=bool), set()
    # whether a span starts or ends at a piece depends on its words, so copies come in order
    for x, s, e in zip(h.tolist(), first.tolist(), end.tolist(), strict=True):
        if x in taken or x in seen:
            gone[s:e] = True
        seen.add(x)
    if not gone.any():
        return text, len(pieces), 0, 0
    keep = "".join(p for p, g in zip(pieces, gone.tolist(), strict=True) if not g)
    return keep, len(pieces), int(gone.sum()), int(np.array(counts)[gone].sum())


def taken_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans, first_docs): per document the hashes of its spans that a
    smaller doc_id holds, and those doc_ids."""
    rows = docs.where("doc_id is not null and text is not null")
    found = save(rows.mapInArrow(_collect, "span bigint, doc_id bigint"), "spans")
    shared = found.groupBy("span").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    return (
        found.join(shared.select("span", "first"), "span")
        .where("doc_id > first")
        .groupBy("doc_id")
        .agg(F.collect_set("span").alias("spans"), F.sort_array(F.collect_set("first")).alias("first_docs"))
    )


#: Names that the cleaning adds to the columns of the documents.
ADDED = ("n_sentences", "n_removed", "n_words_removed", "first_docs")
_TAKEN, _FIRST, _KEY = "__taken_spans", "__first_docs", "__row_key"


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose doc_id is theirs alone, and the others (if there are any)
    with ``__key``, a number beyond all doc_ids; those are written once."""
    name = F.col("doc_id").cast("long")
    counts = docs.groupBy(name.alias("__id")).agg(F.count(F.lit(1)).alias("n"))
    shared = save(counts.where("n > 1 or __id is null").select("__id"), "spans-shared-ids")
    n = shared.count()
    if not n:
        return docs, None
    mark = maybe_broadcast(shared, n)
    beyond = (docs.agg(F.max(name)).first()[0] or 0) + 1
    several = docs.join(mark, name.eqNullSafe(F.col("__id")), "left_semi").withColumn(_KEY, F.lit(beyond) + F.monotonically_increasing_id())
    return docs.join(mark, name.eqNullSafe(F.col("__id")), "left_anti"), save(several, "spans-shared-rows")


def _with_taken(docs: DataFrame, taken: DataFrame, key: F.Column) -> DataFrame:
    return docs.join(taken, key == F.col("__id"), "left").drop("__id", _KEY)


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` with cleaned texts and the columns of ``ADDED``, which replace
    columns of the same names."""
    base = docs.drop(*ADDED)
    single, several = _numbered(base)
    rows = single.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if several is not None:
        rows = rows.unionByName(several.select(F.col(_KEY).alias("doc_id"), "text"))
    taken = taken_spans(rows)
    taken = taken.select(F.col("doc_id").alias("__id"), F.col("spans").alias(_TAKEN), F.col("first_docs").alias(_FIRST))
    joined = _with_taken(single, taken, F.col("doc_id").cast("long"))
    if several is not None:
        # first rows are named by their doc_id, null ones left out
        names = several.select(F.col(_KEY).alias("__first"), F.col("doc_id").cast("long").alias("__name"))
        taken = save(taken, "spans-taken")
        firsts = taken.select("__id", F.explode(_FIRST).alias("__first")).join(names, "__first", "left")
        own = F.when(F.col("__first") < F.lit(several.agg(F.min(_KEY)).first()[0]), F.col("__first")).otherwise(F.col("__name"))
        firsts = firsts.groupBy("__id").agg(F.sort_array(F.collect_set(own)).alias(_FIRST))
        taken = taken.drop(_FIRST).join(firsts, "__id")
        joined = _with_taken(single, taken, F.col("doc_id").cast("long")).unionByName(_with_taken(several, taken, F.col(_KEY)))
    schema = T.StructType([
        *base.schema.fields,
        *(T.StructField(c, T.LongType()) for c in ADDED[:3]),
        T.StructField(ADDED[3], T.ArrayType(T.LongType())),
    ])

    def run(batches):
        powers = _Powers()
        for b in batches:
            done = [
                _clean_text(t, set(s or ()), powers)
                for t, s in zip(b.column("text").to_pylist(), b.column(_TAKEN).to_pylist(), strict=True)
            ]
            first = b.column(_FIRST)
            out = b.drop_columns([_TAKEN, _FIRST])
            at = out.schema.get_field_index("text")
            out = out.set_column(at, out.schema.field(at), pa.array([d[0] for d in done], out.schema.field(at).type))
            for k, name in enumerate(ADDED[:3], 1):
                out = out.append_column(name, pa.array([d[k] for d in done], pa.int64()))
            yield out.append_column(ADDED[3], first)

    return joined.mapInArrow(run, schema)
