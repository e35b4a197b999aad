"""Every query against the plain-Python result, over whole test tables and over a nasty fixture."""

import os

import brute
import nasty
import pyarrow.parquet as pq
import pytest

from lifeline.llm import queries as Q
from lifeline.llm.queries import URL_RULES, tokenizer

SF = "/root/testdata/sf0.001"


def _table(path, name, cols):
    return list(zip(*(pq.read_table(f"{path}/{name}.parquet").column(c).to_pylist() for c in cols), strict=True))


@pytest.fixture(scope="module", params=["generated", "nasty"])
def folder(request, spark, tmp_path_factory):
    """Test tables: the generated ones, and nasty documents beside generated other tables."""
    if request.param == "generated":
        return SF
    out = str(tmp_path_factory.mktemp("nasty"))
    for name in ("benchmark", "labels", "conversations", "pages"):
        os.symlink(f"{SF}/{name}.parquet", f"{out}/{name}.parquet")
    spark.createDataFrame(nasty.documents(), nasty.SCHEMA).repartition(3).write.parquet(f"{out}/documents.parquet")
    return out


@pytest.fixture(scope="module")
def docs(folder):
    return sorted(_table(folder, "documents", ["doc_id", "text"]))


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_op1(spark, folder, docs):
    got = Q.op1_decontaminate(spark, folder)
    assert _rows(got, *got.columns) == sorted(brute.contamination(docs, _table(folder, "benchmark", ["item_id", "text"])))


def test_op2(spark, folder):
    got = _rows(Q.op2_chat_trees(spark, folder), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert got == sorted(brute.chats(_table(folder, "conversations", ["conv_id", "turn", "role", "text"])))


def test_op3(spark, folder):
    got = _rows(Q.op3_url_rules(spark, folder), "page_id", "host", "path", "rule", "verdict")
    want = [(i, *brute.url(u, URL_RULES)) for i, u in _table(folder, "pages", ["page_id", "url"])]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_op4(spark, folder, docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in Q.op4_minmax_dedup(spark, folder).collect()}
    assert got == brute.near(docs, 4, 80)


def test_op5(spark, folder, docs):
    got = _rows(Q.op5_bpe_words(spark, folder), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(brute.bpe(docs, tokenizer("word_bpe_49k.json")))


def test_op6(spark, folder, docs):
    got = {r["doc_id"]: r for r in Q.op6_pii_votes(spark, folder).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        base = brute.private(text)
        r = got[doc_id]
        listed = [f"{k}:{s}:{e}" for k, s, e in base]
        assert [r[f"n_{k}"] for k in brute.PII] == [sum(b[0] == k for b in base) for k in brute.PII], doc_id
        assert r["base_sha256"] == brute.sha(",".join(listed))
        assert set(listed) <= set(r["spans"].split(",")) or not listed


def test_op8(spark, folder, docs):
    got = _rows(Q.op8_token_files(spark, folder), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == list(brute.token_file(docs, tokenizer("byte_bpe_50k.json")))


def test_op9(spark, folder, docs):
    import zlib

    rows = Q.op9_virtual_slots(spark, folder).collect()
    texts = dict(docs)
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    shards = {}
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        shards.setdefault(r["shard"], []).append(r)
    assert set(shards) <= set(range(16))
    for own in shards.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    sizes = [sum(r["size"] for r in own) for own in shards.values()]
    # what can't be narrowed by moving one record
    assert max(sizes) - min(sizes) <= max(r["size"] for r in rows)


def test_op10(spark, folder, docs):
    rows = Q.op10_decision_list(spark, folder).collect()
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {r["doc_id"]: tuple(r[c] for c in cols) for r in rows} == {d: brute.quality(t) for d, t in docs}
    assert not any(r["kept"] and r["base_failed"] for r in rows)
