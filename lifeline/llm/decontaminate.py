"""Benchmark decontamination by a broadcast set of normalised n-grams.

A benchmark item becomes its windows of ``width`` consecutive words (an item
of fewer words, but not none, is one window).  The windows are broadcast as a
hash set; each batch of documents is mapped to benchmark word numbers, windows
made only of benchmark words are looked up by a rolling hash, and each hit is
confirmed on the words themselves.  No shuffle is needed.

The benchmark is broadcast in blocks of at most ``block_bytes`` of item text.
One block is the usual case; with more, the documents pass through the blocks
one after the other with the hits so far in a column, so the result does not
depend on the number of blocks.

Defined results: a null or empty text has no words and is clean; a null
``item_id`` marks words but is not listed; repeated items count once; repeated
documents are judged one by one; other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifeline.llm.tables import save

WIDTH = 13
#: Share of a document's words inside benchmark windows that makes it contaminated: 1 / MIN_SHARE.
MIN_SHARE = 20
BLOCK_BYTES = 32 << 20

#: Words are runs of 0-9, a-z (after lower-casing A-Z) and non-ASCII bytes; all else separates.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_FOLD).split() if text else []


class NgramSet:
    """Windows of one block of benchmark items, for lookups of whole batches."""

    def __init__(self, items: list[tuple[object, str | None]], width: int):
        self.vocab: dict[bytes, int] = {}
        owners: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
        for item_id, text in items:
            ids = np.array(
                [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)], dtype=np.int32
            )
            n = min(width, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                own = owners[n][ids[i : i + n].tobytes()]
                if item_id is not None:
                    own.add(str(item_id))
        self.owners = {n: {k: tuple(v) for k, v in w.items()} for n, w in owners.items()}
        rng = np.random.default_rng(7)
        self.mix = rng.integers(1, 2**63, len(self.vocab) + 1, dtype=np.int64).view(np.uint64)
        self.step = rng.integers(1, 2**63, width, dtype=np.int64).view(np.uint64) | np.uint64(1)
        self.hashes = {
            n: np.unique(self._hash(np.frombuffer(b"".join(w), dtype=np.int32).reshape(-1, n).T))
            for n, w in self.owners.items()
        }

    @classmethod
    def of(cls, state: dict) -> NgramSet:
        """From the plain fields of another, as they are broadcast."""
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out

    def _hash(self, columns) -> np.ndarray:
        total = np.uint64(0)
        for k, col in enumerate(columns):
            total = total + self.mix[col] * self.step[k]
        return total

    def spans(self, ids: np.ndarray) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """(start, end, items) of each window that occurs in ``ids``; 0 is no benchmark word."""
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        for n, known in self.hashes.items():
            if len(ids) < n:
                continue
            at = np.flatnonzero(unknown[n:] == unknown[:-n])
            if not len(at):
                continue
            h = self._hash(ids[at + k] for k in range(n))
            pos = np.minimum(np.searchsorted(known, h), len(known) - 1)
            for s in at[known[pos] == h].tolist():
                owner = self.owners[n].get(ids[s : s + n].tobytes())
                if owner is not None:
                    yield s, s + n, owner

    def mark(self, texts: list[str | None]) -> tuple[list[int], list[list[int]], list[set[str]]]:
        """Per text: its words, the merged [start, end) word spans as a flat list, the items."""
        get, ids, starts = self.vocab.get, [], []
        for t in texts:
            starts.append(len(ids))
            ids += [get(w, 0) for w in words_of(t)]
            ids.append(0)
        ends = np.array([*starts[1:], len(ids)]) - 1
        spans: list[list[int]] = [[] for _ in texts]
        items: list[set[str]] = [set() for _ in texts]
        found = sorted(self.spans(np.array(ids, dtype=np.int32)))
        docs = np.searchsorted(ends, [s for s, _, _ in found], side="left").tolist()
        for (s, e, own), d in zip(found, docs, strict=True):
            items[d].update(own)
            s, e = s - starts[d], e - starts[d]
            if spans[d] and s <= spans[d][-1]:
                spans[d][-1] = max(spans[d][-1], e)
            else:
                spans[d] += [s, e]
        return (ends - np.array(starts)).tolist(), spans, items


def _merge(a: list[int], b: list[int]) -> list[int]:
    out: list[int] = []
    for s, e in sorted([*zip(a[::2], a[1::2], strict=True), *zip(b[::2], b[1::2], strict=True)]):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def judge(n_words: int, spans: list[int]) -> tuple[int, bool]:
    hit = sum(spans[1::2]) - sum(spans[::2])
    return hit, hit > 0 and MIN_SHARE * hit >= n_words


def _cut(text: str, spans: list[int]) -> str:
    """``text`` without the words of ``spans`` (and what stands between them)."""
    raw = text.encode("utf-8", "replace")
    folded, at, pos = raw.translate(_FOLD), [], 0
    for w in folded.split():
        pos = folded.index(w, pos)
        at.append((pos, pos + len(w)))
        pos += len(w)
    out, last = [], 0
    for s, e in zip(spans[::2], spans[1::2], strict=True):
        out.append(raw[last : at[s][0]])
        last = at[e - 1][1]
    return b"".join([*out, raw[last:]]).decode("utf-8", "replace")


def _blocks(benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    return [items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == b) for b in range(n)]


_HITS = "__hits"
_ITEMS = "__items"


def _run(docs: DataFrame, benchmark: DataFrame, width: int, block_bytes: int, finish, schema: T.StructType) -> DataFrame:
    """Pass ``docs`` through every block; ``finish(batch, n_words, spans, items)``
    turns the last pass into an output batch."""
    spark = docs.sparkSession
    blocks = _blocks(benchmark, block_bytes)
    carried = T.StructType([
        *docs.schema.fields,
        T.StructField(_HITS, T.ArrayType(T.IntegerType())),
        T.StructField(_ITEMS, T.ArrayType(T.StringType())),
    ])
    for k, block in enumerate(blocks):
        grams = spark.sparkContext.broadcast(vars(NgramSet([tuple(r) for r in block.collect()], width)))
        last = k == len(blocks) - 1

        def scan(batches, grams=grams, last=last, first=k == 0):
            known = NgramSet.of(grams.value)
            for batch in batches:
                n, spans, items = known.mark(batch.column("text").to_pylist())
                if not first:
                    spans = [_merge(a, b) for a, b in zip(batch.column(_HITS).to_pylist(), spans, strict=True)]
                    items = [set(a) | b for a, b in zip(batch.column(_ITEMS).to_pylist(), items, strict=True)]
                    batch = batch.drop_columns([_HITS, _ITEMS])
                if last:
                    yield finish(batch, n, spans, items)
                else:
                    yield batch.append_column(_HITS, pa.array(spans, pa.list_(pa.int32()))).append_column(
                        _ITEMS, pa.array([sorted(x) for x in items], pa.list_(pa.string()))
                    )

        docs = docs.mapInArrow(scan, schema if last else carried)
        if not last:
            docs = save(docs, "decontaminate")
    return docs


REPORT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.IntegerType())),
])


def report(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: words, hit words, items and the verdict; ``spans``
    holds the hit word ranges as a flat [start, end, ...] list."""

    def finish(batch, n, spans, items):
        judged = [judge(*x) for x in zip(n, spans, strict=True)]
        names = [sorted(x) for x in items]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n, pa.int64()),
                pa.array([h for h, _ in judged], pa.int64()),
                pa.array([len(x) for x in names], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], pa.string()),
                pa.array([c for _, c in judged], pa.bool_()),
                pa.array(names, pa.list_(pa.string())),
                pa.array(spans, pa.list_(pa.int32())),
            ],
            names=REPORT.names,
        )

    return _run(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, width, block_bytes, finish, REPORT)


def remove_documents(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without contaminated documents, same columns."""

    def finish(batch, n, spans, items):
        return batch.filter(pa.array([not judge(*x)[1] for x in zip(n, spans, strict=True)], pa.bool_()))

    return _run(docs, benchmark, width, block_bytes, finish, docs.schema)


def remove_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the hit words cut out of contaminated documents, same columns."""

    def finish(batch, n, spans, items):
        texts = [
            _cut(t, s) if judge(k, s)[1] else t
            for t, k, s in zip(batch.column("text").to_pylist(), n, spans, strict=True)
        ]
        at = batch.schema.get_field_index("text")
        return batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return _run(docs, benchmark, width, block_bytes, finish, docs.schema)
