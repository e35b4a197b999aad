"""Chat formatting of reply trees.

Input rows are messages ``(tree_id, node_id, parent_id, role, text, score)``.
Root-to-leaf paths are found by iterative self-joins that double their reach:
after round k every message knows its ancestor 2^k replies up and the score
and length of the way there, so a thread of depth d needs log2(d) joins.  The
branches (leaves) of a tree are ranked by mean score, and the chosen ones are
expanded to their messages by joining the same tables downwards from the
largest step.  Each chosen path becomes one formatted conversation.

Template, one block per turn::

    <|im_start|>role\\n
    text<|im_end|>\\n

A control string inside a text gets a backslash after its first character (one
more if there are some already), which is undone exactly on reading.
``loss_spans`` are the [start, end) code-point ranges of assistant texts.

Defined results: a null text or role is empty; messages without a tree or node
id belong to no conversation and are left out; of repeated (tree, node) rows
the smallest (role, text) stays; a parent that does not exist makes its reply
a root; messages whose parents form a cycle reach no root and are on no path;
equal scores are settled by depth, then by the smaller leaf id.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lifeline.llm.tables import save

#: Control strings of the template and of other common chat templates.
CONTROL = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_TAILS = "|".join(re.escape(c[1:]) for c in CONTROL)
_PLAIN = re.compile(rf"([<\[])(\\*)(?={_TAILS})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)(?={_TAILS})")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turns(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[int]]:
    """The conversation and the flat [start, end, ...] ranges of its assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<|im_start|>{_role_out(role or '')}\n", escape(text or "")
        if role == "assistant":
            spans += [at + len(head), at + len(head) + len(body)]
        parts += [head, body, "<|im_end|>\n"]
        at += len(head) + len(body) + len(parts[-1])
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    return [(_role_in(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def _ancestors(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables (tree_id, node_id, anc) of steps 1, 2, 4, ... and, per message
    that hangs on a root, the score and length of its way to it."""
    ids = nodes.select("tree_id", "node_id", "parent_id", "score")
    known = ids.select("tree_id", F.col("node_id").alias("parent_id"), F.col("node_id").alias("anc"))
    up = save(
        ids.join(known, ["tree_id", "parent_id"], "left").select(
            "tree_id", "node_id", "anc", F.coalesce("score", F.lit(0.0)).alias("total"), F.lit(1).cast("long").alias("length")
        ),
        "chat-up",
    )
    steps, rows = [], up.count()
    ended, open_ = up.where(F.col("anc").isNull()), up.where(F.col("anc").isNotNull())
    while open_.limit(1).count() and 2 ** len(steps) <= rows:
        steps.append(open_.select("tree_id", "node_id", "anc"))
        above = ended.union(open_).select(
            "tree_id",
            F.col("node_id").alias("anc"),
            F.col("anc").alias("next"),
            F.col("total").alias("total_up"),
            F.col("length").alias("length_up"),
        )
        # only messages that have not reached their root take part
        up = save(
            open_.join(above, ["tree_id", "anc"]).select(
                "tree_id",
                "node_id",
                F.col("next").alias("anc"),
                (F.col("total") + F.col("total_up")).alias("total"),
                (F.col("length") + F.col("length_up")).alias("length"),
            ),
            "chat-up",
        )
        ended, open_ = ended.union(up.where(F.col("anc").isNull())), up.where(F.col("anc").isNotNull())
    return steps, ended.drop("anc")


def ranked_paths(nodes: DataFrame, top_k: int = 1) -> DataFrame:
    """(tree_id, path, pos, role, text): the messages of the ``top_k`` best branches of each tree."""
    nodes = save(
        nodes.where(F.col("tree_id").isNotNull() & F.col("node_id").isNotNull())
        .groupBy("tree_id", "node_id")
        .agg(F.min(F.struct("role", "text", "parent_id", F.col("score").cast("double").alias("score"))).alias("m"))
        .select("tree_id", "node_id", "m.*"),
        "chat-nodes",
    )
    steps, ways = _ancestors(nodes)
    parents = nodes.where(F.col("parent_id").isNotNull()).select("tree_id", F.col("parent_id").alias("node_id")).distinct()
    best = Window.partitionBy("tree_id").orderBy(
        F.desc(F.col("total") / F.col("length")), F.desc("length"), F.asc("node_id")
    )
    path = (
        ways.join(parents, ["tree_id", "node_id"], "left_anti")
        .withColumn("path", F.row_number().over(best))
        .where(F.col("path") <= top_k)
        .select("tree_id", "path", "node_id", F.col("length").alias("pos"))
    )
    for k in range(len(steps) - 1, -1, -1):
        path = path.join(steps[k], ["tree_id", "node_id"], "left").select(
            "tree_id",
            "path",
            F.explode(
                F.filter(
                    F.array(
                        F.struct("node_id", "pos"),
                        F.struct(F.col("anc").alias("node_id"), (F.col("pos") - 2**k).alias("pos")),
                    ),
                    lambda x: x["node_id"].isNotNull(),
                )
            ).alias("m"),
        ).select("tree_id", "path", "m.*")
    return path.join(nodes.select("tree_id", "node_id", "role", "text"), ["tree_id", "node_id"]).select(
        "tree_id", "path", "pos", "role", "text"
    )


def format_paths(paths: DataFrame) -> DataFrame:
    """(tree_id, path, formatted, loss_spans): one conversation per chosen path."""
    turns = paths.groupBy("tree_id", "path").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("turns"))
    tree_type = turns.schema["tree_id"].dataType.simpleString()

    def write(batches):
        for b in batches:
            done = [format_turns([(t["role"], t["text"]) for t in x]) for x in b.column("turns").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("tree_id"),
                    b.column("path"),
                    pa.array([x for x, _ in done], pa.string()),
                    pa.array([x for _, x in done], pa.list_(pa.int64())),
                ],
                names=["tree_id", "path", "formatted", "loss_spans"],
            )

    return turns.mapInArrow(write, f"tree_id {tree_type}, path int, formatted string, loss_spans array<bigint>")


def linear_nodes(conversations: DataFrame) -> DataFrame:
    """Messages of unbranched conversations (conv_id, turn, role, text): each
    turn answers the one before.  Rows of a conversation are put in order by
    (turn, role, text); a conversation is one output value, so its rows meet."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return (
        conversations.select("conv_id", "turn", "role", "text")
        .where(F.col("conv_id").isNotNull())
        .withColumn("node_id", F.row_number().over(order).cast("long"))
        .select(
            F.col("conv_id").alias("tree_id"),
            "node_id",
            F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"),
            "role",
            "text",
            F.lit(0.0).alias("score"),
        )
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Read conversations back from their formatted text and loss spans."""

    def read(batches):
        for b in batches:
            rows = []
            for text, spans in zip(b.column("formatted").to_pylist(), b.column("loss_spans").to_pylist(), strict=True):
                turns = parse(text)
                loss = "".join(unescape(text[s:e]) for s, e in zip(spans[::2], spans[1::2], strict=True))
                all_turns = "".join(f"{r}\n{t}\n" for r, t in turns)
                rows.append((len(turns), _sha(all_turns), len(loss), _sha(loss), len(text)))
            n, turns_sha, loss_chars, loss_sha, chars = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("tree_id"),
                    pa.array(n, pa.int64()),
                    pa.array(turns_sha, pa.string()),
                    pa.array(loss_chars, pa.int64()),
                    pa.array(loss_sha, pa.string()),
                    pa.array(chars, pa.int64()),
                ],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    kind = formatted.schema["tree_id"].dataType.simpleString()
    return formatted.mapInArrow(
        read,
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
