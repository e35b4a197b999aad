"""Groups whose members are near the bound, as a chain, star or cloud."""

import random

import brute

from lifeline.llm import minmax_dedup
from lifeline.llm.components import components


def _cloud(rng, base, n, most):
    """Copies with up to ``most`` replaced words, some of them copies of copies."""
    out = [base]
    for _ in range(n):
        words = list(rng.choice(out[:8]))
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        out.append(words)
    return out


def test_cloud_matches_brute_force(spark):
    rng = random.Random(11)
    vocab = [f"v{k}" for k in range(400)]
    docs = []
    for size, most in ((120, 8), (60, 12), (1, 0), (40, 3)):
        base = [rng.choice(vocab) for _ in range(130)]
        docs += _cloud(rng, base, size, most)
    chain = [rng.choice(vocab) for _ in range(100)]
    for _ in range(30):  # each is near the one before only
        chain = list(chain)
        for k in rng.sample(range(100), 2):
            chain[k] = f"y{rng.randrange(10**6)}"
        docs.append(chain)
    rng.shuffle(docs)
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    got = minmax_dedup.groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), 4, 80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.near(rows, 4, 80)


def test_components_of_long_paths(spark):
    rng = random.Random(2)
    ids = list(range(500))
    rng.shuffle(ids)
    edges = list(zip(range(0, 300), range(1, 301))) + [(ids[k] + 1000, ids[k + 1] + 1000) for k in range(200)] + [(5, 5)]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    label = {r["node"]: r["label"] for r in got}
    assert len({label[k] for k in range(301)}) == 1
    assert len({label[ids[k] + 1000] for k in range(201)}) == 1
    assert label[0] != label[ids[0] + 1000]


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rows_without_ids_or_words(spark):
    text = "one two three four five six seven eight"
    rows = [(None, text), (None, text), (3, text), (7, text), (7, text), (8, ""), (9, None), (1, " \t"), (2, "one"), (4, "ONE")]
    df = spark.createDataFrame([(*r, "k", 1, True) for r in rows], "doc_id bigint, text string, node string, n int, kept boolean")
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"], r["kept"]) for r in minmax_dedup.groups(df).collect())
    assert got == [
        (-1, 4, None, True), (-1, 4, None, True), (1, 0, 1, True), (2, 1, 2, True), (3, 4, 3, True),
        (4, 1, 2, False), (7, 4, 3, False), (7, 4, 3, False), (8, 0, 8, True), (9, 0, 9, True),
    ]
    kept = minmax_dedup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, -1, 1, 2, 3, 8, 9]


def test_empty_table(spark):
    assert minmax_dedup.groups(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_repeated_rows_keep_one(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta"
    df = spark.createDataFrame([(5, text)] * 4 + [(6, text + " iota")] + [(9, "other words entirely here now")], "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in minmax_dedup.keep_one(df).collect()) == [5, 9]


def test_unrelated_texts_of_one_id_all_stay(spark):
    """Against plain Python: documents are (doc_id, text) pairs, one of each linked group stays."""
    import random

    import brute

    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(25):
        base = [word() for _ in range(60)]
        for _ in range(rng.randint(1, 4)):
            near = list(base)
            for _ in range(rng.randint(0, 1)):
                near[rng.randrange(60)] = word()
            rows += [(rng.choice([5, 6, 7, rng.randint(10, 60)]), " ".join(near), rng.choice("xy"))] * rng.choice([1, 1, 3])
    rows += [(5, "", "x"), (5, None, "x"), (5, "", "x"), (None, rows[0][1], "x"), (None, rows[0][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id string")
    results = []
    for parts in (1, 4):
        kept = sorted(((r["doc_id"], r["text"], r["id"]) for r in minmax_dedup.keep_one(docs.repartition(parts)).collect()), key=repr)
        results.append([(i, t) for i, t, _ in kept])
        distinct = sorted({(i, t) for i, t, _ in rows if i is not None}, key=repr)
        label = brute.near([(k, t) for k, (_, t) in enumerate(distinct)], 5, 80)
        group = {d: label[k][1] for k, d in enumerate(distinct)}
        said = [d for d in results[-1] if d[0] is not None]
        assert len(said) == len(set(said)), "equal rows fold"
        assert sorted(group[d] for d in said) == sorted(set(group.values())), "one of each group"
        assert sum(i is None for i, _ in results[-1]) == 2
    assert len({t for i, t in results[0] if i in (5, 6, 7)}) > 3


def test_extra_columns_decide_in_a_stated_order(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", c) for c in "zyx"] + [(1, "g h i j k l", "q")], "doc_id bigint, text string, source string")
    assert sorted(tuple(r) for r in minmax_dedup.keep_one(docs.repartition(3)).collect()) == [(1, "a b c d e f", "x"), (1, "g h i j k l", "q")]
