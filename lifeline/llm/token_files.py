"""Token files: zstandard frames per document with a shared dictionary.

Layout below ``path`` (all written and read by Spark, so any store will do):

``dictionary``  one row: format, id width in bytes, end id, dictionary, its sha256
``segments``    rows in ascending doc_id order: part, segment, first and last
                doc_id, doc_ids, n_tokens, offsets (n + 1 into ``frames``),
                frames, sha256 of the dictionary
``index``       a narrow row per segment: part, segment, n_docs, n_tokens, start

A document is one frame: its ids, end id included, as little-endian unsigned
integers of ``width`` bytes.  A short document is read by its segment's row
and offset alone (``lookup``); ``start`` is the number of ids before it.

The dictionary is trained on ``SAMPLE_CHARS`` characters, from an offset picked
by hash, of about ``SAMPLE_DOCS`` documents, those with the smallest hashes, a
fixed bound whatever the corpus; only the compression ratio depends on it.

Defined results: a null or empty text is the end id alone; rows with a null
doc_id come first; rows with the same doc_id are in order of text; an empty
table gives empty files; other columns are not stored.
"""

from __future__ import annotations

import hashlib
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lifeline.llm.bpe_words import id_type, load, word_encoder
from lifeline.llm.pretokens import Splitter
from lifeline.llm.tables import hashed_sample, maybe_broadcast

FORMAT = 1
END_ID = 0
SAMPLE_DOCS = 2_000
SAMPLE_CHARS = 4_096
DICTIONARY_BYTES = 64 << 10
SEGMENT_BYTES = 4 << 20
SEGMENT_DOCS = 8_192
#: Words whose ids a worker remembers.
MEMO_WORDS = 600_000

_SEGMENT = (
    "part int, segment int, first_doc bigint, last_doc bigint, doc_ids array<bigint>, n_tokens array<bigint>, "
    "offsets array<bigint>, frames binary, dictionary_sha256 string"
)


class Encoder:
    """Ids of whole texts as bytes; words that were seen are not encoded again."""

    def __init__(self, path: str, end_id: int = END_ID):
        tokenizer = load(path)
        ids, kind = word_encoder(path), id_type(tokenizer)
        self.width = np.dtype(kind).itemsize
        self.split, self.end = Splitter(tokenizer), np.array([end_id], dtype=kind).tobytes()

        class Memo(dict):
            def __missing__(self, word: str) -> bytes:
                if len(self) >= MEMO_WORDS:
                    self.clear()
                out = self[word] = np.array(ids(word), dtype=kind).tobytes()
                return out

        self.memo = Memo()

    def __call__(self, text: str | None) -> bytes:
        return b"".join(map(self.memo.__getitem__, self.split(text))) + self.end


def worker_encoder(path: str) -> Encoder:
    """One encoder per worker process: a task finds what tasks before it in the
    same process remember.  The place is a module of its own, since functions
    that are pickled by value have no lasting globals."""
    place = sys.modules.setdefault("lifeline_worker_encoders", types.ModuleType("lifeline_worker_encoders"))
    if path not in vars(place):
        vars(place)[path] = Encoder(path)
    return vars(place)[path]


def train_dictionary(docs: DataFrame, path: str) -> bytes:
    """A zstandard dictionary from the bounded sample; empty if there is too little text."""
    starts = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64("text", "doc_id"), starts) + 1).cast("int")
    sample = hashed_sample(docs, SAMPLE_DOCS, "doc_id").select(F.substring("text", start, F.lit(SAMPLE_CHARS)).alias("text")).collect()
    encode = Encoder(path)
    arrays = [encode(r["text"]) for r in sample]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, arrays)) // 8), arrays).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _dictionary(data: bytes):
    return zstandard.ZstdCompressionDict(data) if data else None


def _write(path: str, dictionary: bytes, sha: str):
    def run(batches):
        encode = worker_encoder(path)
        frame = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(dictionary)).compress
        part, segment = TaskContext.get().partitionId(), 0
        ids, counts, frames = [], [], []

        def row():
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in frames])))
            own = [x for x in ids if x is not None]
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "part": part, "segment": segment, "first_doc": min(own, default=None), "last_doc": max(own, default=None),
                        "doc_ids": ids, "n_tokens": counts, "offsets": offsets.tolist(), "frames": b"".join(frames), "dictionary_sha256": sha,
                    }
                ],
                schema=pa.schema(
                    [
                        ("part", pa.int32()), ("segment", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
                        ("frames", pa.binary()), ("dictionary_sha256", pa.string()),
                    ]
                ),
            )

        size = 0
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                data = encode(text)
                ids.append(doc_id)
                counts.append(len(data) // encode.width)
                frames.append(frame(data))
                size += len(frames[-1])
                if size >= SEGMENT_BYTES or len(ids) >= SEGMENT_DOCS:
                    yield row()
                    ids, counts, frames, size, segment = [], [], [], 0, segment + 1
        if ids:
            yield row()

    return run


def write(docs: DataFrame, out: str, path: str) -> None:
    """Write the token files of ``docs`` (doc_id, text) below ``out``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    data = train_dictionary(docs, path)
    sha, width = hashlib.sha256(data).hexdigest(), Encoder(path).width
    spark.createDataFrame(
        [(FORMAT, width, END_ID, bytearray(data), sha)], "format int, width int, end_id int, dictionary binary, sha256 string"
    ).coalesce(1).write.parquet(f"{out}/dictionary")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the hash splits the rows of a doc_id that is repeated very often
    docs.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text").mapInArrow(
        _write(path, data, sha), _SEGMENT
    ).write.option("compression", "none").parquet(f"{out}/segments")
    segments = spark.read.parquet(f"{out}/segments").select(
        "part", "segment", F.size("doc_ids").cast("long").alias("n_docs"), F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens")
    )
    # a row per partition of the writer
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn(
        "base", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select("part", "base")
    before = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    segments.join(parts, "part").select(
        "part", "segment", "n_docs", "n_tokens", (F.col("base") + F.coalesce(before, F.lit(0))).alias("start")
    ).write.parquet(f"{out}/index")


def _open(spark: SparkSession, out: str) -> tuple[bytes, int, str]:
    head = spark.read.parquet(f"{out}/dictionary").first()
    if head["format"] != FORMAT:
        raise ValueError(f"token files of format {head['format']}")
    return bytes(head["dictionary"]), head["width"], head["sha256"]


def _frames(batch: pa.RecordBatch, dictionary: bytes, width: int, sha: str, wanted=None):
    """(doc_id, start in the segment, ids) of each document of a batch of segments."""
    read = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress
    for seg in batch.to_pylist():
        if seg["dictionary_sha256"] != sha:
            raise ValueError("a segment was written with another dictionary")
        at, frames = 0, seg["frames"]
        for j, (doc_id, n) in enumerate(zip(seg["doc_ids"], seg["n_tokens"], strict=True)):
            if wanted is None or doc_id in wanted:
                data = read(frames[seg["offsets"][j] : seg["offsets"][j + 1]], max_output_size=n * width)
                yield doc_id, at, np.frombuffer(data, dtype=f"<u{width}").astype("<u4")
            at += n


def read(spark: SparkSession, out: str, emit, fields: str, wanted=None) -> DataFrame:
    """(doc_id, start, *fields): ``emit(ids)`` gives the fields of a document."""
    dictionary, width, sha = _open(spark, out)
    names = ["part", "segment", "doc_id", "at", *(f.split()[0] for f in fields.split(", "))]

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                one = b.slice(k, 1)
                part, segment = one.column("part")[0].as_py(), one.column("segment")[0].as_py()
                rows = [dict(zip(names, (part, segment, doc_id, at, *emit(ids)), strict=True)) for doc_id, at, ids in _frames(one, dictionary, width, sha, wanted)]
                yield from pa.Table.from_pylist(rows, schema=schema).to_batches()

    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    schema = pa.schema(
        [("part", pa.int32()), ("segment", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64())]
        + [(f.split()[0], kinds[f.split()[1]]) for f in fields.split(", ")]
    )
    segments = spark.read.parquet(f"{out}/segments")
    if wanted is not None:
        low, high = min(wanted, default=0), max(wanted, default=-1)
        segments = segments.where((F.col("first_doc") <= high) & (F.col("last_doc") >= low))
    rows = segments.mapInArrow(run, f"part int, segment int, doc_id bigint, at bigint, {fields}")
    index = spark.read.parquet(f"{out}/index").select("part", "segment", F.col("start").alias("base"))
    return rows.join(maybe_broadcast(index, index.count()), ["part", "segment"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), *names[4:]
    )


def lookup(spark: SparkSession, out: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, start, ids) of a few documents; other frames are not decompressed."""
    return read(spark, out, lambda ids: (ids.tobytes(),), "ids binary", frozenset(doc_ids))


def digests(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    return read(spark, out, lambda ids: (len(ids), zlib.crc32(ids.tobytes())), "n_tokens bigint, ids_crc32 bigint")
