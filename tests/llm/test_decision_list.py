"""The learner on known concepts, its expression, bad labels, and held-out documents."""

import random

import pytest
from pyspark.sql import functions as F

from lifeline.llm import decision_list as D

SF = "/root/testdata/sf0.1"


def _rows(n, bad, seed=1, noise=0.0):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x = {name: rng.random() for name in D.FEATURES}
        out.append((x, int(bad(x) != (rng.random() < noise))))
    return out


def _fires(rules, x):
    return any(all(c.holds(x) for c in rule) for rule in rules)


CONCEPTS = {
    "one threshold": lambda x: x["symbols"] >= 0.7,
    "a conjunction": lambda x: x["upper"] >= 0.6 and x["digits"] < 0.4,
    "two rules": lambda x: x["symbols"] >= 0.85 or (x["bangs"] >= 0.7 and x["repeats"] >= 0.6),
}


@pytest.mark.parametrize("name", CONCEPTS)
@pytest.mark.parametrize("noise", [0.0, 0.02])
def test_concepts_are_learned(name, noise):
    bad = CONCEPTS[name]
    rules = D.learn(_rows(6_000, bad, noise=noise))
    held_out = _rows(3_000, bad, seed=2)
    caught = sum(_fires(rules, x) for x, y in held_out if y)
    wrong = sum(_fires(rules, x) for x, y in held_out if not y)
    n_bad = sum(y for _, y in held_out)
    assert caught >= 0.85 * n_bad and wrong <= 0.03 * (len(held_out) - n_bad)
    assert len(rules) <= 2 and any(len(rule) > 1 for rule in rules) == (name != "one threshold" or noise > 0)


def test_growth_takes_the_best_condition_and_pruning_drops_idle_ones():
    rows = _rows(2_000, CONCEPTS["one threshold"])
    grid = {name: [k / 20 for k in range(1, 20)] for name in D.FEATURES}
    rule = D._grow(rows, grid)
    assert rule[0] == D.Condition("symbols", True, 0.7)
    assert D._prune((rule[0], D.Condition("upper", True, 0.0)), rows) == (rule[0],)
    assert D._prune((D.Condition("upper", True, 0.0), rule[0]), rows) == (rule[0],)
    assert D._prune((rule[0], D.Condition("upper", True, 0.5)), rows)[0] == rule[0]


@pytest.mark.parametrize("rows", [[], _rows(50, lambda x: False), _rows(50, lambda x: True), _rows(3, lambda x: x["upper"] > 0.5)], ids=["none", "good", "bad", "few"])
def test_nothing_to_learn(rows):
    rules = D.learn(rows)
    assert not any(_fires(rules, x) for x, y in rows if not y)


def test_the_expression_says_what_the_rules_say(spark):
    rules = D.learn(_rows(4_000, CONCEPTS["two rules"]))
    # shares as parts of 1000, so that both sides divide alike
    rng = random.Random(4)
    parts = [[rng.randint(0, 1_000) for _ in D.FEATURES] for _ in range(300)]
    wholes = sorted({w for _, w in D.FEATURES.values()})
    columns = [p for p, _ in D.FEATURES.values()]
    by_row = [dict(zip(D.FEATURES, (k / 1_000 for k in row), strict=True)) for row in parts]
    # each feature alone: word_chars is a part and a whole, so it is judged by its own test
    simple = [n for n in D.FEATURES if D.FEATURES[n][0] not in wholes and D.FEATURES[n][1] not in columns]
    rules = [r for r in rules if all(c.feature in simple for c in r)] or [(D.Condition(simple[0], True, 0.5),)]
    frame = spark.createDataFrame([tuple([k, *row]) for k, row in enumerate(parts)], ["k", *(f"p_{n}" for n in D.FEATURES)])
    for name in simple:
        part, whole = D.FEATURES[name]
        frame = frame.withColumn(part, F.col(f"p_{name}")).withColumn(whole, F.lit(1_000))
    got = {r["k"]: r["passed"] for r in frame.select("k", D.passes(rules).alias("passed")).collect()}
    assert got == {k: not _fires(rules, x) for k, x in enumerate(by_row)}
    assert D.passes([])._jc.toString() == "true"


def test_labels_out_of_line(spark):
    """Null, clashing, repeated and unknown labels, and no usable ones at all."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    texts = [" ".join(word() + ("#*" if k % 2 and j % 3 == 0 else "") for j in range(120)) for k in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    good = [(k, 0 if k % 2 else 1, 0) for k in range(400)]
    odd = [(None, 1, 0), (5, None, 0), (7, 2, 0), (9_999, 1, 0), (1, 1, 0), (2, 1, 0), (2, 1, 0)]
    schema = "doc_id bigint, quality int, toxic int"
    rules = D.train(docs, spark.createDataFrame(good + odd, schema))
    judged = {r["doc_id"]: r["kept"] for r in D.judge(docs, rules).collect()}
    # thresholds are quantiles, so a step of them (a 32nd of the rows) may pass
    assert all(judged[k] for k in range(0, 400, 2)) and sum(judged[k] for k in range(1, 400, 2)) <= 400 / D.THRESHOLDS
    assert D.train(docs, spark.createDataFrame(odd[:4], schema)) == []
    assert D.train(docs.limit(0), spark.createDataFrame(good, schema)) == []


def test_held_out_documents(spark):
    """Learned on two thirds of the labels; on the others the list rejects low quality and leaves good documents."""
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    side = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    rules = D.train(docs, labels.where(side > 0))
    held = labels.where(side == 0).select("doc_id", "quality")
    rows = D.judge(docs.join(F.broadcast(held), "doc_id", "left_semi"), rules).join(held, "doc_id").select("quality", "kept", "base_failed").collect()
    low, fine = [r for r in rows if r["quality"] == 0], [r for r in rows if r["quality"] == 1]
    assert len(low) > 100 and len(fine) > 500
    assert sum(not r["kept"] for r in low) >= 0.8 * len(low)
    assert sum(not r["kept"] for r in fine if not r["base_failed"]) <= 0.02 * len(fine)
