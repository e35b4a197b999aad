"""Folded merges against the tiktoken library, and the byte round trip."""

import hashlib
import random

import nasty
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

from lifeline.llm import byte_bpe
from lifeline.llm.queries import op13_byte_bpe, tokenizer

SF = "/root/testdata/sf0.001"
PATH, PATTERN = tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


def _want(library, doc_id, text):
    ids = library.encode_ordinary(text or "")
    return (
        doc_id,
        len(ids),
        hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(library.decode_bytes(ids)).hexdigest(),
    )


def test_the_query(spark, library):
    table = pq.read_table(f"{SF}/documents.parquet")
    rows = zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True)
    assert sorted(tuple(r) for r in op13_byte_bpe(spark, SF).collect()) == sorted(_want(library, i, t) for i, t in rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("lifeline_") and not t.isTemporary]


def test_nasty_texts_in_many_chunks(spark, library):
    texts = [*nasty.TEXTS, "ab" * 5_000, "=" * 3_000 + " " * 1_000 + "x", "ᲊ\U00032000 Ɤ1 \U000105c0", "don't we'll I'M", "  a   b\n\n c ", "x\x01y \x01\x01 \x01", "é" * 128, "é" * 129]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, chunk string, ids int").repartition(3)
    got = byte_bpe.digests(docs, PATH, PATTERN, chunk_chars=2_000)
    assert sorted(tuple(r) for r in got.collect()) == [_want(library, i, t) for i, t in enumerate(texts)]


def test_null_repeated_and_no_rows(spark, library):
    rows = [(None, "a b"), (1, "a b"), (1, "a b"), (1, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((tuple(r) for r in byte_bpe.digests(docs, PATH, PATTERN).collect()), key=repr)
    assert got == sorted((_want(library, i, t) for i, t in rows), key=repr)
    assert byte_bpe.digests(docs.limit(0), PATH, PATTERN).count() == 0


def test_ids_and_bytes(spark, library):
    text = "Grüße, 漢字! " * 3
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    ids = byte_bpe.encode(docs, PATH, PATTERN)
    row = ids.withColumn("bytes", byte_bpe.decode(F.col("ids"), byte_bpe.piece_literal(PATH))).first()
    assert row["ids"] == library.encode_ordinary(text) and bytes(row["bytes"]) == text.encode()


def test_folds_of_random_bytes(spark, library):
    """Merges from letters of few kinds, where many pairs tie, and of long words."""
    rng = random.Random(3)
    words = {"".join(rng.choice(kind) for _ in range(rng.randint(1, 60))) for kind in ("ab", "the", "aeiou", "xyzéß漢", "=-") for _ in range(80)}
    words = {w for w in words if len(byte_bpe.Splitter(PATTERN)(w)) == 1}
    rows = [(chunk, k, w) for k, w in enumerate(sorted(words)) for chunk in range(2)]
    packs = [(chunk, byte_bpe.ALONE if k % 9 == 0 else k % 7, k, w) for chunk, k, w in rows]
    got = byte_bpe.encode_listed(spark.createDataFrame(packs, "chunk bigint, pack int, first int, words string"), PATH, PATTERN)
    ids = sorted((r["of_chunk"], r["number"], np.frombuffer(r["ids"], ">u2").tolist()) for r in got.collect())
    assert ids == [(chunk, k, library.encode_ordinary(w)) for chunk, k, w in sorted(rows)]


def test_fold_does_not_depend_on_vocabulary_order(spark):
    """A pair that a merge makes may have a lower rank than the merge itself."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"aba": 290, b"bab": 280, b"abab": 310}
    own = tiktoken.Encoding("few", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    words = ["ab" * k for k in range(1, 9)] + ["ba" * k for k in range(1, 9)] + ["aabb", "abba", "babab"]
    fold = byte_bpe._let(byte_bpe.rank_literal(ranks), lambda maps: byte_bpe.fold_merges(maps, F.col("word")))
    got = spark.createDataFrame([(w,) for w in words], "word string").select("word", fold.alias("ids"))
    assert {r["word"]: r["ids"] for r in got.collect()} == {w: own.encode_ordinary(w) for w in words}


def test_the_pattern_spelled_out():
    """The standard library and the full splitter agree on common texts."""
    import re

    import regex

    common, full = re.compile(byte_bpe._narrow(PATTERN)), regex.compile(PATTERN)
    rng = random.Random(8)
    letters = "ab Z'stredmvl019²½ \n\t\x1c\x85\xa0é×Łſ—’€.,-$"
    for _ in range(3_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        assert common.findall(text) == full.findall(text)


def test_words_are_folded_in_spark(spark):
    """The fold is a column expression: no Python beside the words over the bound."""
    plan = spark.createDataFrame([("a",)], "word string").select(byte_bpe.fold_merges(byte_bpe.rank_literal({b"a": 1}), F.col("word")))
    shown = plan._jdf.queryExecution().toString()
    assert "aggregate(" in shown and "Python" not in shown and "Arrow" not in shown


def test_a_merge_builds_no_strings(spark):
    """A step works on numbers: strings of pieces made the fold too slow."""
    words = spark.createDataFrame([("a",)], "word string")
    fold = byte_bpe._let(byte_bpe.rank_literal({b"a": 1}), lambda maps: byte_bpe.fold_merges(maps, F.col("word")))
    shown = words.select(fold)._jdf.queryExecution().optimizedPlan().toString()
    assert "concat(" not in shown and "aggregate(" in shown


def test_table_of_pairs():
    """Every pair is found, by its own key alone, also in a table that has to grow."""
    rng = random.Random(5)
    near = [left * byte_bpe._MIX + right for left in range(1, 60) for right in range(1, 60)]
    for keys in ([], near, [rng.randrange(1, byte_bpe._MIX**2) for _ in range(5_000)], [(k << 40) + 1 for k in range(1, 2)]):
        entries = {key: key << byte_bpe._NUMBER_BITS | 1 + n for n, key in enumerate(keys)}
        slots, shifts = byte_bpe._slots(entries)
        assert sorted(filter(None, slots)) == sorted(entries.values())
        n = 4 * len(shifts)
        assert all(slots[(k & (n - 1)) + shifts[(k ^ k >> byte_bpe._HIGH) & (n // 4 - 1)]] == e for k, e in entries.items())


def test_far_ranks_and_bytes_without_one(spark):
    """Ranks need not follow each other; a byte without a rank merges but has no id."""
    top = 2**31 - 9
    ranks = {b"a": 3, b"b": 1, b"c": 2, b"ab": top + 1, b"bc": top, b"xa": 50, b"xab": 40, b"qqq": 7}
    cases = {"abc": [3, top], "ab": [top + 1], "xabc": [40, 2], "xxa": [None, 50], "x": [None], "aé": [3, None, None], "xab": [40], "qqq": [7]}
    fold = byte_bpe._let(byte_bpe.rank_literal(ranks), lambda maps: byte_bpe.fold_merges(maps, F.col("word")))
    got = spark.createDataFrame([(w,) for w in cases], "word string").select("word", fold.alias("ids"))
    assert {r["word"]: r["ids"] for r in got.collect()} == cases
