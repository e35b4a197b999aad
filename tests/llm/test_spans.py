"""Repeated spans against plain Python on the words themselves, over a whole table and rows that share ids."""

import nasty
import pyarrow.parquet as pq

from lifeline.llm import sentence_spans as S

SF = "/root/testdata/sf0.001"


def _said(piece):
    return " ".join(piece.split()).lower()


def _runs(pieces):
    """(start, end) of the shortest spans from each piece and to each piece."""
    words = [len(p.split()) for p in pieces]
    for i in range(len(pieces)):
        for j in range(i + S.MIN_SENTENCES, len(pieces) + 1):
            if sum(words[i:j]) >= S.MIN_WORDS:
                yield i, j
                break
    for j in range(1, len(pieces) + 1):
        for i in range(j - S.MIN_SENTENCES, -1, -1):
            if sum(words[i:j]) >= S.MIN_WORDS:
                yield i, j
                break


def brute(rows):
    """rows (key, text) in order of key -> the text of each, with first keys of what it lost."""
    first, out = {}, {}
    cut = {k: S.sentences(t)[0] for k, t in rows}
    for k, _ in rows:
        for i, j in _runs(cut[k]):
            first.setdefault(tuple(map(_said, cut[k][i:j])), k)
    for k, text in rows:
        gone, seen, lost = set(), set(), set()
        for i, j in sorted(set(_runs(cut[k]))):
            span = tuple(map(_said, cut[k][i:j]))
            if first[span] != k:
                lost.add(first[span])
            if first[span] != k or span in seen:
                gone |= set(range(i, j))
            seen.add(span)
        out[k] = (text if not gone else "".join(p for n, p in enumerate(cut[k]) if n not in gone), sorted(lost))
    return out


def test_a_whole_table(spark):
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    rows = sorted(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True))
    got = S.clean(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")).collect()
    want = brute(rows)
    assert {r["doc_id"]: (r["text"], r["first_docs"] or []) for r in got} == want
    assert sum(bool(lost) for _, lost in want.values()) > 5


PASSAGE = " ".join(f"Sentence {k} of a passage that several rows share, with words enough." for k in range(8))


def test_null_and_repeated_ids_are_compared(spark):
    rows = [(1, PASSAGE), (1, "Own text first. " + PASSAGE), (None, PASSAGE + " And an end."), (3, "Three starts. " + PASSAGE), (7, "Nothing here."), (1, None), (None, "")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id bigint, text string, __id string")
    got = S.clean(docs.withColumnRenamed("__id", "n").repartition(3)).collect()
    assert len(got) == len(rows)
    holders = [r for r in got if r["text"] and "Sentence 3 of" in r["text"]]
    assert [r["doc_id"] for r in holders] == [3], "the row with an id of its own is the first"
    assert all(r["first_docs"] == [3] for r in got if r["first_docs"])
    only_shared = S.clean(docs.where("doc_id is null or doc_id = 1").withColumnRenamed("__id", "n")).collect()
    assert sum("Sentence 3 of" in (r["text"] or "") for r in only_shared) == 1


def test_nasty_texts(spark):
    rows = [(i, t) for i, t, *_ in nasty.documents()]
    got = {r["doc_id"]: r["text"] for r in S.clean(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()}
    short = [(k, t) for k, t in rows if len(t or "") < 20_000]
    want = brute(short)
    assert all(got[k] == want[k][0] for k, _ in short)
