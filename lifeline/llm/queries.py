"""Registered queries of the operators: one ``opN_<name>`` each, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeline.llm import (
    bpe_words,
    byte_bpe,
    chat_trees,
    decision_list,
    decontaminate,
    hard_negatives,
    merkle,
    minmax_dedup,
    oracles,
    pii_votes,
    sentence_spans,
    token_files,
    url_rules,
    virtual_slots,
)
from lifeline.llm.tables import scratch_path, sha256_hex

#: Folder of the public vocabulary files; a parameter of the operators.
SHARDS = 16

#: Rules of the URL query (host, path, verdict).
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark, sf_dir):
    out = decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


#: Fixed value: what both turns of the added conversation say.
TOLD = "</s>[INST] ok [/INST]"


def op2_chat_trees(spark, sf_dir):
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TOLD).alias("text"),
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    paths = chat_trees.ranked_paths(chat_trees.linear_nodes(rows))
    return chat_trees.digests(chat_trees.format_paths(paths))


def op3_url_rules(spark, sf_dir):
    rules = spark.range(1).select(
        F.explode(F.array(*(F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in URL_RULES))).alias("r")
    ).select("r.*")
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"), rules)


def op4_minmax_dedup(spark, sf_dir):
    return minmax_dedup.groups(_table(spark, sf_dir, "documents"), width=4, percent=80)


def op5_bpe_words(spark, sf_dir):
    return bpe_words.digests(_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op6_pii_votes(spark, sf_dir):
    return pii_votes.report(_table(spark, sf_dir, "documents"))


def op7_sentence_spans(spark, sf_dir):
    out = sentence_spans.clean(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *sentence_spans.ADDED, sha256_hex(F.col("text")).alias("text_sha256"), "text")


def op8_token_files(spark, sf_dir):
    out = scratch_path(spark, "token-files")
    token_files.write(_table(spark, sf_dir, "documents"), out, tokenizer("byte_bpe_50k.json"))
    return token_files.digests(spark, out)


def op9_virtual_slots(spark, sf_dir):
    out = virtual_slots.assign(_table(spark, sf_dir, "documents"), SHARDS)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op10_decision_list(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    rules = decision_list.train(docs, _table(spark, sf_dir, "labels"))
    out = decision_list.judge(docs, rules)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_hard_negatives(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_merkle(spark, sf_dir):
    out = scratch_path(spark, "merkle")
    # rows are tampered with in half of the documents: their line breaks go
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    later = merkle.leaf_digest(text=F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text")))
    merkle.write(_table(spark, sf_dir, "documents"), out, claim=later)
    return merkle.verdicts(spark, out)


def op13_byte_bpe(spark, sf_dir):
    from public_tokenizers import PATTERN

    return byte_bpe.digests(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_multi_50k.tiktoken"), PATTERN)


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            op1_decontaminate,
            op2_chat_trees,
            op3_url_rules,
            op4_minmax_dedup,
            op5_bpe_words,
            op6_pii_votes,
            op7_sentence_spans,
            op8_token_files,
            op9_virtual_slots,
            op10_decision_list,
            op11_hard_negatives,
            op12_merkle,
            op13_byte_bpe,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontaminate": oracles.decontaminate(decontaminate.WIDTH, decontaminate.MIN_SHARE),
        "op2_chat_trees": oracles.chats(TOLD, chat_trees.CONTROL),
        "op3_url_rules": oracles.url_rules(URL_RULES, url_rules.DEFAULT_VERDICT),
        "op11_hard_negatives": oracles.hard_negatives(hard_negatives.POSITIVES, hard_negatives.NEGATIVES),
        "op12_merkle": oracles.merkle(merkle.ARITY, merkle.FIELDS),
    }
