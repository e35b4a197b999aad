"""BPE encoding and decoding over a table of distinct words.

1. Documents are split into pre-tokens ("words").  Each chunk of
   ``CHUNK_CHARS`` of text is coded by its own word list: a row per document
   with word numbers, and the list itself.  The coded rows are written once,
   bucketed by chunk.
2. The word lists are shuffled by word, and each distinct word of the corpus is
   encoded once, by the tokenizer itself.  A common word is one row per chunk
   here, not one per occurrence.
3. The ids go back to their chunks and are joined to the documents by word
   number and position.  The coded rows do not move: they are bucketed by the
   join key.  Decoding joins ids to the pieces of the vocabulary, which is
   bounded and broadcast.

Defined results: a null or empty text has no ids and decodes to the empty
text; special strings of the tokenizer inside a text become their ids, as in
the library; rows with a null or repeated doc_id are coded row by row; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeline.llm.pretokens import Splitter
from lifeline.llm.tables import save_bucketed

#: Characters of text that share a word list; bounds what a task holds.
CHUNK_CHARS = 32 << 20
#: Words of a list that go into one row.
LIST_ROWS = 20_000

_CODED = "chunk bigint, doc_id bigint, codes binary, first int, words array<string>"


def load(path: str):
    """The tokenizer, without padding and truncation."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for a byte: itself if it
    prints, else the next free one from 256."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return {**{b: chr(b) for b in prints}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


def word_encoder(path: str):
    """Ids of one pre-token, which is normalised and split already."""
    tokenizer = load(path)
    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    kinds = json.loads(tokenizer.to_str())["pre_tokenizer"]
    if (kinds or {}).get("pretokenizers", [kinds])[-1]["type"] != "ByteLevel":
        tokenizer.normalizer = None
        return lambda word: tokenizer.encode(word, add_special_tokens=False).ids
    letters, merge = _byte_letters(), tokenizer.model.tokenize

    def ids(word: str) -> list[int]:
        if word in special:
            return [special[word]]
        return [t.id for t in merge(word.encode().decode("latin-1").translate(letters))]

    return ids


def id_type(tokenizer) -> str:
    """The narrowest little-endian type for its ids."""
    return "<u2" if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def pack(codes: np.ndarray) -> bytes:
    """Numbers as byte planes (lowest first), compressed."""
    width = max(1, (int(codes.max(initial=0)).bit_length() + 7) // 8)
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes()
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 4), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.view("<u4").ravel()


def _code(path: str, chunk_chars: int):
    def run(batches):
        split = Splitter(load(path))
        part, seq, size, numbers = TaskContext.get().partitionId(), 0, 0, _Numbers()

        def lists():
            words = list(numbers)
            firsts = range(0, len(words), LIST_ROWS)
            n = len(firsts)
            return _coded([part << 32 | seq] * n, [None] * n, [None] * n, firsts, [words[k : k + LIST_ROWS] for k in firsts])

        for b in batches:
            for at in range(0, b.num_rows, 256):
                rows = b.slice(at, 256)
                codes = []
                for text in rows.column("text").to_pylist():
                    words = split(text)
                    size += len(text or "")
                    codes.append(pack(np.fromiter(map(numbers.__getitem__, words), dtype=np.uint32, count=len(words))))
                n = len(codes)
                yield _coded([part << 32 | seq] * n, rows.column("doc_id"), codes, [None] * n, [None] * n)
                if size >= chunk_chars:
                    yield lists()
                    seq, size, numbers = seq + 1, 0, _Numbers()
        if numbers:
            yield lists()

    return run


def _coded(chunk, doc_id, codes, first, words) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(chunk, pa.int64()),
            doc_id if isinstance(doc_id, pa.Array) else pa.array(doc_id, pa.int64()),
            pa.array(codes, pa.binary()),
            pa.array(first, pa.int32()),
            pa.array(words, pa.list_(pa.string())),
        ],
        names=["chunk", "doc_id", "codes", "first", "words"],
    )


def coded_documents(docs: DataFrame, path: str, chunk_chars: int) -> DataFrame:
    """The coded rows, written once to shared storage, bucketed by chunk."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return save_bucketed(docs.mapInArrow(_code(path, chunk_chars), _CODED), "bpe-coded", "chunk")


def encoded_words(coded: DataFrame, path: str) -> DataFrame:
    """(chunk, number, ids): the ids of every listed word, of the tokenizer's
    ``id_type``; each distinct word is encoded once."""
    n = int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = coded.where("words is not null").select("chunk", "first", F.posexplode("words").alias("pos", "word"))
    words = words.select("word", "chunk", (F.col("first") + F.col("pos")).alias("number"))

    def encode(batches):
        encoder, kind, last, ids = word_encoder(path), id_type(load(path)), None, b""
        for b in batches:
            out = []
            for word in b.column("word").to_pylist():
                if word != last:
                    last, ids = word, np.array(encoder(word), dtype=kind).tobytes()
                out.append(ids)
            yield pa.RecordBatch.from_arrays(
                [b.column("chunk"), b.column("number"), pa.array(out, pa.binary())], names=["chunk", "number", "ids"]
            )

    return words.repartition(n, "word").sortWithinPartitions("word").mapInArrow(encode, "chunk bigint, number int, ids binary")


def vocabulary(path: str) -> list[str]:
    """Pieces by id; bounded by the tokenizer file."""
    pieces = load(path).get_vocab(with_added_tokens=True)
    out = [""] * (max(pieces.values()) + 1)
    for piece, i in pieces.items():
        out[i] = piece
    return out


def _assemble(docs: DataFrame, path: str, chunk_chars: int, fields: str, emit) -> DataFrame:
    """Join ids to documents by position; ``emit(ids, decoded)`` makes the
    columns after doc_id from lists of both."""
    tokenizer = load(path)
    kind = id_type(tokenizer)
    if tokenizer.decoder is not None:
        raise ValueError("decoding joins pieces by spaces; the tokenizer has a decoder of its own")
    coded = coded_documents(docs, path, chunk_chars)
    ids = encoded_words(coded, path)
    pieces = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    rows = coded.where("codes is not null").select("chunk", "doc_id", "codes")
    names = [f.split()[0] for f in fields.split(",")]

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("number").to_numpy())
        each = right.column("ids").to_pylist()
        each = [np.frombuffer(each[k], dtype=kind) for k in order]
        length = np.array([len(x) for x in each], dtype=np.int64)
        start = np.concatenate(([0], np.cumsum(length)))[:-1]
        flat = (np.concatenate(each) if each else np.empty(0)).astype("<u4")
        piece = pieces.value
        text = [" ".join([piece[i] for i in x.tolist()]) for x in each]
        parts, done, texts = [], [], []
        for packed in left.column("codes").to_pylist():
            codes = unpack(packed)
            n = length[codes]
            before = np.cumsum(n) - n
            done.append(flat[np.repeat(start[codes] - before, n) + np.arange(int(n.sum()))])
            texts.append(" ".join([text[c] for c in codes.tolist()]))
            if len(done) == 256:
                parts.append(emit(done, texts))
                done, texts = [], []
        parts.append(emit(done, texts))
        cols = [pa.concat_arrays(c) for c in zip(*parts, strict=True)]
        return pa.Table.from_arrays([left.column("doc_id").combine_chunks(), *cols], names=["doc_id", *names])

    return rows.groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInArrow(join, f"doc_id bigint, {fields}")


def encode(docs: DataFrame, path: str, chunk_chars: int = CHUNK_CHARS // 4) -> DataFrame:
    """(doc_id, ids, decoded): ids as little-endian unsigned 32-bit integers, and the text they decode to."""
    return _assemble(
        docs, path, chunk_chars, "ids binary, decoded string",
        lambda ids, texts: (pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(texts, pa.string())),
    )


def digests(docs: DataFrame, path: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    return _assemble(
        docs, path, chunk_chars, "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        lambda ids, texts: (
            pa.array([len(x) for x in ids], pa.int64()),
            pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
        ),
    )
