"""Byte-level BPE by folds of ranked merges, and decoding from pieces.

1. Documents are split by the vocabulary's pattern.  Each chunk of
   ``CHUNK_CHARS`` of text is coded by its own word list: a row per document
   with word numbers, and the list itself in packs by the words' checksums (a
   string each, so that a word's place tells its number), written once, bucketed
   by chunk.
2. Each distinct word of the corpus is encoded once, by Spark's higher-order
   functions: an ``aggregate`` holds the word's pieces, a long each (what the piece
   and the next one merge to, its place, its number); each step merges the
   leftmost pair of the lowest rank.  The ranks are one literal in the plan, with
   a table of the pairs that merge.  The packs are shuffled whole, and the first row
   of each word's run computes the ids for all of them.
3. The ids go back to their chunks and are joined to the documents by word
   number and position; the coded rows do not move.
4. Decoding concatenates the bytes of the pieces of a document's ids.

A fold takes a step for each byte and copies the arrays in each, so its cost
grows with the square of a word's length: words of more than ``LONG_WORD``
bytes (runs without any break) are encoded by the tiktoken library itself.

Defined results: a null or empty text has no ids and decodes to no bytes;
special strings are ordinary text; rows with a null or repeated doc_id are
coded row by row; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifeline.llm.bpe_words import pack, unpack
from lifeline.llm.pretokens import _L as LETTERS
from lifeline.llm.pretokens import _N as NUMBERS
from lifeline.llm.pretokens import _OTHER as UNCOMMON
from lifeline.llm.pretokens import _SPACE as SPACES
from lifeline.llm.tables import save_bucketed

#: Characters of text that share a word list; bounds what a task holds.
CHUNK_CHARS = 32 << 20
#: Packs of a chunk's words for each task that encodes, and that one batch holds.
PACKS_PER_TASK, PACKS_AT_ONCE = 16, 64
#: Documents that are coded, or whose ids are joined, at a time.
SLICE_DOCS = 256
#: Bytes of the longest word that is folded.
LONG_WORD = 256
#: Stands between the words of a pack; a word that holds it is alone.
SEPARATOR = "\x01"
#: Packs that are none: of a word alone, and of the numbers by pack.
ALONE, RENUMBERED = -1, -2
#: Small maps of the rank literal, a power of two.
RANK_MAPS = 1 << 14
#: Bits of a piece's place, and of its number, in an item of a fold.
_PLACE_BITS, _NUMBER_BITS = 16, 21
#: In place of the number that two pieces merge to: they don't.
_NONE = 1 << _NUMBER_BITS
#: A pair's key is ``_MIX`` times the left number, and the right one; bits from
#: ``_HIGH`` on are its high ones.
_MIX, _HIGH = 1_999_993, 18
#: Bound of the shifts in the table of pairs.
MOST_SHIFT = 1 << 10


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and their ranks, which are their ids; bounded by the file."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


def _narrow(pattern: str) -> str:
    r"""``pattern`` for the standard library, with \p{L}, \p{N} and \s spelled out
    for the characters of ``pretokens``' common texts."""
    inside = {r"\p{L}": LETTERS, r"\p{N}": NUMBERS, r"\s": SPACES}
    out, in_class, at = "", False, 0
    for found in re.finditer(r"\\p\{[LN]\}|\\s|\\S|\\.|[\[\]]", pattern):
        token = found.group()
        out += pattern[at : found.start()]
        at = found.end()
        if token in "[]":
            in_class = token == "["
        if token == r"\S":
            out += f"[^{SPACES}]"
        elif token in inside:
            out += inside[token] if in_class else f"[{inside[token]}]"
        else:
            out += token
    return out + pattern[at:]


class Splitter:
    """Matches of ``pattern`` in a text, as the tiktoken library finds them.

    Common texts are split by the standard library.  For others, the regular
    expressions of tiktoken know an older Unicode than the ``regex`` module:
    characters beyond the common Latin ones are looked up in both once, and
    those that are letters or numbers for ``regex`` alone are split as symbols.
    """

    def __init__(self, pattern: str):
        import regex
        import tiktoken

        self.common = re.compile(_narrow(pattern)).findall
        self.find, self.spans = regex.compile(pattern).findall, regex.compile(pattern).finditer
        one_byte = {bytes([b]): b for b in range(256)}
        self.classes = [
            (regex.compile(c).match, tiktoken.Encoding(f"class {c}", pat_str=c, mergeable_ranks=one_byte, special_tokens={}).encode_ordinary)
            for c in (r"\p{L}", r"\p{N}", r"\s")
        ]
        self.agreed, self.symbols = set(map(chr, range(0x250))), {}

    def __call__(self, text: str | None) -> list[str]:
        if not text:
            return []
        if text.isascii() or not UNCOMMON.search(text):
            return self.common(text)
        for c in set(text) - self.agreed:
            if c in self.symbols:
                continue
            if all(bool(match(c)) == bool(tokens(c)) for match, tokens in self.classes):
                self.agreed.add(c)
            else:
                self.symbols[c] = "#"
        if not self.symbols or self.symbols.keys().isdisjoint(text):
            return self.find(text)
        return [text[m.start() : m.end()] for m in self.spans(text.translate(str.maketrans(self.symbols)))]


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def _code(pattern: str, chunk_chars: int, n_packs: int):
    """Rows of documents (doc_id, codes), of packs of their chunk's words (pack,
    first, words), of words alone (pack ``ALONE``), and of the numbers by pack that the
    codes' numbers become (pack ``RENUMBERED``)."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.string()]

    def rows(*columns):
        n = max(len(c) for c in columns if c is not None)
        return pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.nulls(n, k) if c is None else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["chunk", "doc_id", "codes", "pack", "first", "words"],
        )

    def run(batches):
        split = Splitter(pattern)
        part, seq, size, numbers = TaskContext.get().partitionId(), 0, 0, _Numbers()

        def chunk(n):
            return [part << 32 | seq] * n

        def packs():
            """Words are numbered anew, pack by pack, so a word's place tells its number."""
            words, said = list(numbers), [w.encode() for w in numbers]
            alone = np.array([len(b) > LONG_WORD or SEPARATOR in w for w, b in zip(words, said, strict=True)])
            pack_of = np.where(alone, ALONE, np.array([zlib.crc32(b) % n_packs for b in said], dtype=np.int32))
            order = np.argsort(pack_of, kind="stable")
            number = np.empty(len(words), dtype=np.uint32)
            number[order] = np.arange(len(words))
            yield rows(chunk(1), None, [pack(number)], [RENUMBERED], None, None)
            n = int(alone.sum())
            if n:
                yield rows(chunk(n), None, None, [ALONE] * n, range(n), [words[k] for k in order[:n]])
            ends = np.flatnonzero(np.diff(pack_of[order[n:]], append=-1)) + 1 + n
            runs = [(a, order[a:b]) for a, b in zip([n, *ends[:-1]], ends, strict=True) if b > a]
            for at in range(0, len(runs), PACKS_AT_ONCE):
                some = runs[at : at + PACKS_AT_ONCE]
                texts = [SEPARATOR.join([words[k] for k in r]) for _, r in some]
                yield rows(chunk(len(some)), None, None, [pack_of[r[0]] for _, r in some], [a for a, _ in some], texts)

        for b in batches:
            for at in range(0, b.num_rows, SLICE_DOCS):
                part_of = b.slice(at, SLICE_DOCS)
                codes = []
                for text in part_of.column("text").to_pylist():
                    words = split(text)
                    size += len(text or "")
                    codes.append(pack(np.fromiter(map(numbers.__getitem__, words), dtype=np.uint32, count=len(words))))
                yield rows(chunk(len(codes)), part_of.column("doc_id"), codes, None, None, None)
                if size >= chunk_chars:
                    yield from packs()
                    seq, size, numbers = seq + 1, 0, _Numbers()
        if numbers:
            yield from packs()

    return run


def coded_documents(docs: DataFrame, pattern: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """The rows of ``_code``, written once, bucketed by chunk."""
    n_packs = PACKS_PER_TASK * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fields = "chunk bigint, doc_id bigint, codes binary, pack int, first int, words string"
    return save_bucketed(docs.mapInArrow(_code(pattern, chunk_chars, n_packs), fields), "byte-bpe-coded", "chunk")


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once.  An element of a ``transform``
    would do too, but its type is worked out anew for each row."""
    return F.aggregate(F.array(), value, lambda value, _: value, body)


def _numbers(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """Numbers of pieces inside a fold: from 1 in the order of ranks, above all those of bytes without a rank."""
    bare = [bytes([b]) for b in range(256) if bytes([b]) not in ranks]
    return {piece: n for n, piece in enumerate([*sorted(ranks, key=ranks.__getitem__), *bare], 1)}


def _slots(entries: dict[int, int]) -> tuple[list[int], list[int]]:
    """A table of twice as many slots, in which a key's entry is at slot
    (low bits of the key) + (shift of its low and high bits).  Free slots hold 0."""
    bits = max(1, len(entries)).bit_length() + 1
    while True:
        n, together = 1 << bits, {}
        for key in entries:
            together.setdefault((key ^ key >> _HIGH) & (n // 4 - 1), []).append(key)
        slots, shifts = [0] * (n + MOST_SHIFT), [0] * (n // 4)
        for at, keys in sorted(together.items(), key=lambda x: -len(x[1])):
            places = {key & (n - 1) for key in keys}
            shift = next((d for d in range(MOST_SHIFT) if not any(slots[p + d] for p in places)), None)
            if shift is None or len(places) < len(keys):
                break
            shifts[at] = shift
            for key in keys:
                slots[(key & (n - 1)) + shift] = entries[key]
        else:
            return slots, shifts
        bits += 1


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """What folds look up, as one literal: ``whole`` (ranks by hexadecimal piece,
    in ``RANK_MAPS`` maps), ``bytes`` (numbers of the 256 bytes), ``ranks`` by
    number, and the table of pairs, whose entries are a pair's key and the number
    of its merge."""
    maps: list[dict[str, int]] = [{} for _ in range(RANK_MAPS)]
    for piece, rank in ranks.items():
        name = piece.hex().upper()
        maps[zlib.crc32(name.encode()) & (RANK_MAPS - 1)][name] = rank
    numbers = _numbers(ranks)
    if len(numbers) >= _MIX:
        raise ValueError(f"a vocabulary of {_MIX} pieces or more")
    pairs: dict[int, int] = {}
    for piece in ranks:
        for k in range(1, len(piece)):
            left, right = numbers.get(piece[:k]), numbers.get(piece[k:])
            if left and right:
                key = left * _MIX + right
                pairs[key] = key << _NUMBER_BITS | numbers[piece]
    slots, shifts = _slots(pairs)
    values = {
        "whole": (maps, "array<map<string,bigint>>"),
        "bytes": ([numbers[bytes([b])] for b in range(256)], "array<bigint>"),
        "ranks": (sorted(ranks.values()), "array<bigint>"),
        "slots": (slots, "array<bigint>"),
        "shifts": (shifts, "array<bigint>"),
        "slot_mask": (4 * len(shifts) - 1, "bigint"),
        "shift_mask": (len(shifts) - 1, "bigint"),
    }
    said = json.dumps({name: value for name, (value, _) in values.items()}, separators=(",", ":"))
    return F.from_json(F.lit(said), ", ".join(f"{name} {kind}" for name, (_, kind) in values.items()))


def _rank(maps: Column, piece: Column) -> Column:
    """The rank of a hexadecimal piece, null if it has none."""
    at = F.crc32(piece.cast("binary")).bitwiseAND(RANK_MAPS - 1)
    return F.try_element_at(F.get(maps["whole"], at.cast("int")), piece)


def _merged(maps: Column, left: Column, right: Column) -> Column:
    """The number that two neighbouring pieces merge to; ``_NONE`` if they don't."""

    def found(key: Column) -> Column:
        shift = F.get(maps["shifts"], key.bitwiseXOR(F.shiftright(key, _HIGH)).bitwiseAND(maps["shift_mask"]).cast("int"))
        entry = F.get(maps["slots"], (key.bitwiseAND(maps["slot_mask"]) + shift).cast("int"))
        # an entry of the same key leaves the number alone, any other more than _NONE
        return F.least(entry.bitwiseXOR(F.shiftleft(key, _NUMBER_BITS)), F.lit(_NONE))

    return _let(left * _MIX + right, found)


def _number(item: Column) -> Column:
    return item.bitwiseAND(_NONE - 1)


def _joined(*arrays: Column) -> Column:
    """Their elements in one array; less costly than ``concat`` inside a lambda."""
    return F.flatten(F.array(*arrays))


def _merge(maps: Column, items: Column) -> Column:
    """The items after the next merge.  An item is a piece: from the highest bits
    what it and the next piece merge to, the place of its first byte, its own
    number.  So the least item is the left piece of the next merge.  The first and
    the last item stand for no piece."""
    high = _NUMBER_BITS + _PLACE_BITS
    places = (1 << high) - _NONE

    def item(left: Column, right: Column, of: Column) -> Column:
        return F.shiftleft(_merged(maps, left, right), high).bitwiseOR(of)

    def least(low: Column) -> Column:
        def from_place(place: Column) -> Column:
            at = F.size(F.filter(items, lambda x: x.bitwiseAND(places) <= place))
            return _let(at, lambda at: merge(at, place))

        def merge(at: Column, place: Column) -> Column:
            new, before, after = F.shiftright(low, high), F.get(items, at - 2), F.get(items, at + 1)
            changed = F.array(
                item(_number(before), new, before.bitwiseAND((1 << high) - 1)),
                item(new, _number(after), place.bitwiseOR(new)),
            )
            return _joined(F.slice(items, F.lit(1), at - 2), changed, F.slice(items, at + 2, F.size(items)))

        return F.when(low >= _NONE << high, items).otherwise(_let(low.bitwiseAND(places), from_place))

    return _let(F.array_min(items), least)


def fold_merges(maps: Column, word: Column) -> Column:
    """Ids of a word of at least one byte, as an array of int."""
    said, edge = F.encode(word, "UTF-8"), F.array(F.lit(0).cast("long"))
    letters = F.split(F.decode(said, "ISO-8859-1"), "")  # a character here is a byte of the word
    numbers = _joined(edge, F.transform(letters, lambda c: F.get(maps["bytes"], F.ascii(c))), edge)

    def folded(numbers: Column) -> Column:
        def item(number: Column, k: Column) -> Column:
            merged = _merged(maps, number, F.coalesce(F.get(numbers, k + 1), F.lit(0)))
            return F.shiftleft(F.shiftleft(merged, _PLACE_BITS).bitwiseOR(k.cast("long")), _NUMBER_BITS).bitwiseOR(number)

        steps = F.slice(numbers, F.lit(3), F.size(numbers))
        return F.aggregate(steps, F.transform(numbers, item), lambda items, _: _merge(maps, items))

    def ids(items: Column) -> Column:
        pieces = F.slice(items, F.lit(2), F.size(items) - 2)
        return F.transform(pieces, lambda x: F.get(maps["ranks"], (_number(x) - 1).cast("int")).cast("int"))

    whole = _rank(maps, F.hex(said)).cast("int")  # a word that is a piece is not merged from bytes
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(_let(_let(numbers, folded), ids))


def id_width(ranks: dict[bytes, int]) -> int:
    """Bytes of an id in the packed ids of a word."""
    return 2 if max(ranks.values(), default=0) < 1 << 16 else 4


def encode_listed(packs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(of_chunk, number, ids) of the words of all packs (chunk, pack, first,
    words) and of those alone; ids are big-endian, of ``id_width`` bytes.  Rows of a word meet in one
    sorted run, whose first row encodes it for all."""
    ranks = read_ranks(path)
    width, kind = id_width(ranks), f">u{id_width(ranks)}"
    n = int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = packs.where(F.col("pack") >= 0).repartition(n, "pack")
    listed = shared.select(F.col("chunk").alias("of_chunk"), "pack", "first", F.posexplode(F.split("words", SEPARATOR)).alias("place", "word"))
    listed = listed.select("of_chunk", "pack", (F.col("first") + F.col("place")).alias("number"), "word")
    run = Window.partitionBy("pack", "word").orderBy("of_chunk", "number")
    folded = _let(rank_literal(ranks), lambda maps: fold_merges(maps, F.col("word")))
    packed = F.unhex(F.array_join(F.transform(folded, lambda i: F.lpad(F.hex(i), 2 * width, "0")), ""))
    rows = listed.withColumn("nth", F.row_number().over(run))
    rows = rows.withColumn("own", F.when(F.col("nth") == 1, packed))
    so_far = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    short = rows.select("of_chunk", "number", F.first("own", ignorenulls=True).over(so_far).alias("ids"))

    def by_library(batches):
        import tiktoken

        encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={}).encode_ordinary
        for b in batches:
            ids = [np.array(encode(w), dtype=kind).tobytes() for w in b.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("of_chunk"), b.column("number"), pa.array(ids, pa.binary())], names=["of_chunk", "number", "ids"])

    alone = packs.where(F.col("pack") == ALONE).select(F.col("chunk").alias("of_chunk"), F.col("first").alias("number"), F.col("words").alias("word"))
    return short.unionByName(alone.mapInArrow(by_library, "of_chunk bigint, number int, ids binary"))


def _assemble(docs: DataFrame, path: str, pattern: str, chunk_chars: int, fields: str, emit) -> DataFrame:
    """Join the words' ids to documents by position.  ``emit(each)`` is called with
    the id arrays of a chunk's words and gives a function from the word numbers of
    a document to its values of ``fields``."""
    coded = coded_documents(docs, pattern, chunk_chars)
    ids = encode_listed(coded.where("words is not null").select("chunk", "pack", "first", "words"), path, pattern)
    rows = coded.where("codes is not null").select("chunk", "doc_id", "codes", "pack")
    kind, names = f">u{id_width(read_ranks(path))}", [f.split()[0] for f in fields.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    schema = pa.schema([("doc_id", pa.int64()), *((f.split()[0], kinds[f.split()[1]]) for f in fields.split(", "))])

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("number").to_numpy())
        packed = right.column("ids").to_pylist()
        values = emit([np.frombuffer(packed[k], dtype=kind).astype(np.int32) for k in order])
        is_doc = left.column("pack").is_null()
        renumbered = left.filter(pc.invert(is_doc)).column("codes").to_pylist()
        number = unpack(renumbered[0]) if renumbered else np.empty(0, dtype=np.uint32)
        left, out = left.filter(is_doc), []
        for at in range(0, left.num_rows, SLICE_DOCS):
            part = left.slice(at, SLICE_DOCS)
            columns = zip(*(values(number[unpack(codes)]) for codes in part.column("codes").to_pylist()), strict=True)
            arrays = [pa.array(c, schema.field(n).type) for n, c in zip(names, columns, strict=True)]
            out.append(pa.Table.from_arrays([part.column("doc_id").combine_chunks(), *arrays], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return rows.groupBy("chunk").cogroup(ids.groupBy("of_chunk")).applyInArrow(join, f"doc_id bigint, {fields}")


def encode(docs: DataFrame, path: str, pattern: str, chunk_chars: int = CHUNK_CHARS // 4) -> DataFrame:
    """(doc_id, ids array<int>) of every row of ``docs`` (doc_id, text)."""

    def emit(each):
        none = np.empty(0, dtype=np.int32)
        return lambda codes: (np.concatenate([none, *(each[c] for c in codes.tolist())]),)

    return _assemble(docs, path, pattern, chunk_chars, "ids array<int>", emit)


def piece_literal(path: str) -> Column:
    """Hexadecimal pieces by id, as one literal."""
    ranks = read_ranks(path)
    names = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        names[rank] = piece.hex().upper()
    return F.split(F.lit(",".join(names)), ",")


def decode(ids: Column, pieces: Column) -> Column:
    """The bytes of an id array; an id without a piece has none."""
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))


def digests(docs: DataFrame, path: str, pattern: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256 of the decimal ids, decoded_sha256 of the
    decoded bytes).  Ids are written out, and decoded, once for each word of a
    chunk; a document's are those of its words in a row."""

    def emit(each):
        piece = {rank: name for name, rank in read_ranks(path).items()}
        length = np.array([len(x) for x in each], dtype=np.int64)
        text = [",".join(map(str, x.tolist())).encode() for x in each]
        data = [b"".join([piece[i] for i in x.tolist()]) for x in each]

        def values(codes):
            at = codes.tolist()
            said, decoded = b",".join([text[c] for c in at]), b"".join([data[c] for c in at])
            return int(length[codes].sum()), hashlib.sha256(said).hexdigest(), hashlib.sha256(decoded).hexdigest()

        return values

    return _assemble(docs, path, pattern, chunk_chars, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", emit)
