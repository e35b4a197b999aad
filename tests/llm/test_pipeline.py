"""The pipeline over a whole table: every document that goes is accounted for, stage by stage."""

import re

import brute
import corpus_pipeline
import pytest

from lifeline.llm import decision_list, pii_votes
from lifeline.llm.tables import save

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows (doc_id, text) after each stage, with the columns."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    out["documents"] = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = save(stage(spark, docs, SF), f"test-{name}")
        if name != "tokens":
            assert docs.columns == columns
            out[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        else:
            out[name] = {r["doc_id"]: tuple(r) for r in docs.collect()}
    return out


def test_quality(spark, stages):
    before = stages["documents"]
    rules = decision_list.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    judged = {r["doc_id"]: r for r in decision_list.judge(spark.read.parquet(f"{SF}/documents.parquet"), rules).collect()}
    for doc_id, text in before.items():
        failed = brute.quality(text)[-1]
        assert judged[doc_id]["base_failed"] == failed
        assert (doc_id in stages["quality"]) == judged[doc_id]["kept"]
    assert 0 < len(stages["quality"]) < len(before)


def test_near_dedup(stages):
    before, after = stages["quality"], stages["near_dedup"]
    groups = brute.near(sorted(before.items()), 5, 80)
    assert set(after) == {i for i, (_, smallest) in groups.items() if i == smallest}
    assert all(after[i] == before[i] for i in after) and len(after) < len(before)


def test_decontamination(stages):
    import pyarrow.parquet as pq

    items = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()
    before, after = stages["near_dedup"], stages["decontamination"]
    found = {r[0]: r[-1] for r in brute.contamination(sorted(before.items()), list(zip(items["item_id"], items["text"], strict=True)))}
    assert set(after) == {i for i in before if not found[i]}


def test_masking(stages):
    before, after = stages["decontamination"], stages["masking"]
    assert set(after) == set(before)
    changed = {i for i in after if after[i] != before[i]}
    assert {i for i in before if brute.private(before[i])} <= changed
    for i in after:
        kept = {(k, s, e) for k, s, e in brute.private(after[i])}
        assert not kept, "no strict span is left"
        if i not in changed:
            assert after[i] == before[i]
    assert {k.upper() for k in pii_votes.KINDS} >= {x for i in changed for x in re.findall(r"\[([A-Z]+)\]", after[i]) if f"[{x}]" not in before[i]}


def test_tokens(stages):
    from lifeline.llm.queries import tokenizer

    want = {r[0]: tuple(r) for r in brute.bpe(sorted(stages["masking"].items()), tokenizer("word_bpe_49k.json"))}
    assert stages["tokens"] == want
