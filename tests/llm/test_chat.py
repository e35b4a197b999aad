"""Reply trees: ranking, repeated rows, orphans, cycles, escaping."""

import random

from lifeline.llm import chat_trees as C

FIELDS = "tree_id bigint, node_id bigint, parent_id bigint, role string, text string, score double"


def _paths(spark, rows, top_k=1):
    got = C.ranked_paths(spark.createDataFrame(rows, FIELDS), top_k).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r["tree_id"], r["path"], r["pos"])):
        out.setdefault((r["tree_id"], r["path"]), []).append(r["text"])
    return out


def test_branches_are_ranked_by_mean_score(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0),
        (1, 2, 1, "assistant", "bad", -1.0),
        (1, 3, 1, "assistant", "good", 2.0),
        (1, 4, 3, "user", "more", None),
        (1, 5, 4, "assistant", "end", 4.0),
        (2, 1, None, "user", "alone", None),
    ]
    assert _paths(spark, rows, 2) == {
        (1, 1): ["q", "good", "more", "end"], (1, 2): ["q", "bad"], (2, 1): ["alone"],
    }


def test_ties_repeats_orphans_and_cycles(spark):
    rows = [
        (1, 1, None, "user", "root", 0.0), (1, 1, None, "user", "root", 0.0),
        (1, 2, 1, "a", "x", 0.0), (1, 3, 1, "a", "y", 0.0),
        (3, 5, 99, "user", "orphan", 1.0),
        (4, 1, 2, "u", "c1", 0.0), (4, 2, 1, "u", "c2", 0.0), (4, 3, 2, "u", "hangs", 0.0),
        (None, 1, None, "u", "no tree", 0.0), (5, None, None, "u", "no node", 0.0),
        (6, 1, None, None, None, None),
    ]
    assert _paths(spark, rows) == {(1, 1): ["root", "x"], (3, 1): ["orphan"], (6, 1): [None]}


def test_random_trees_match_a_walk(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for tree in range(12):
        n = rng.choice([1, 2, 7, 40])
        parent = {k: rng.randrange(max(0, k - 3), k) if k else None for k in range(n)}
        score = {k: float(rng.randrange(5)) for k in range(n)}
        rows += [(tree, k, parent[k], "user", f"{tree}-{k}", score[k]) for k in range(n)]
        ways = {}
        for leaf in set(parent) - set(parent.values()):
            way, at = [], leaf
            while at is not None:
                way.append(at)
                at = parent[at]
            ways[leaf] = way[::-1]
        best = min(ways, key=lambda x: (-sum(score[k] for k in ways[x]) / len(ways[x]), -len(ways[x]), x))
        want[tree, 1] = [f"{tree}-{k}" for k in ways[best]]
    rng.shuffle(rows)
    assert _paths(spark, rows) == want


def test_round_trip_of_control_strings():
    rng = random.Random(9)
    bits = [*C.CONTROL, "\\", "<", "[", "|", "\n", "a", "<|im", "_end|>", "/INST]", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        escaped = C.escape(text)
        assert not any(c in escaped for c in C.CONTROL)
        assert C.unescape(escaped) == text
        turns = [(rng.choice(["user", "assistant", "a\nb\\n", "<s>"]), text), ("assistant", text)]
        formatted, spans = C.format_turns(turns)
        assert C.parse(formatted) == turns
        assert C.unescape(formatted[spans[-2] : spans[-1]]) == text


def test_empty_table(spark):
    empty = spark.createDataFrame([], FIELDS)
    assert C.digests(C.format_paths(C.ranked_paths(empty))).count() == 0
