"""URL allow/block rules by a sort-merge range join.

A host becomes a canonical key, its labels reversed and closed by dots
(``www.example.net`` -> ``net.example.www.``), so a rule's host and all its
subdomains are one interval of keys and rule intervals are nested or disjoint.
URLs are range-partitioned by (key, id), which also splits a hot host; each
rule goes to the partitions that its interval meets, found by bisecting the
partitions' first and last keys.  In each partition one sweep over rules and
URLs in key order keeps the stack of rules that are open at the current key,
and the longest open rule whose path starts the URL's path decides.

Longest: the rule with the most characters (host and path); then the longer
host; then block before allow.  Defined results: a null URL or one without
``://`` has an empty host and path and fits no rule; a URL that fits none gets
the default verdict; rules with a null or empty host or a null path are void;
repeated URLs are judged one by one; a rule given twice is one rule.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeline.llm.tables import save

DEFAULT_VERDICT = "allow"
#: Above every character that a key can hold.
_TOP = "\U0010ffff"

_OUT = "page_id bigint, host string, path string, rule string, verdict string"


def host_of(url: F.Column) -> F.Column:
    """ASCII-lower-cased text after the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return F.translate(
        F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )


def path_of(url: F.Column) -> F.Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: F.Column) -> F.Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


class _Open:
    """Rules of one host: verdicts by path, with the path lengths that occur."""

    def __init__(self, key: str):
        self.key, self.by_path, self.lengths = key, {}, []

    def add(self, path: str, rule: str, verdict: str) -> None:
        if path not in self.by_path or verdict == "block":
            self.by_path[path] = (rule, verdict)
        self.lengths = []

    def best(self, path: str) -> tuple[str, str] | None:
        self.lengths = self.lengths or sorted({len(p) for p in self.by_path}, reverse=True)
        return next((r for n in self.lengths if n <= len(path) and (r := self.by_path.get(path[:n]))), None)


def _sweep(batches, default):
    part, stack = None, []
    for b in batches:
        out = []
        for pid, key, is_url, page_id, host, path, rule, verdict in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if pid != part:
                part, stack = pid, []
            while stack and not key.startswith(stack[-1].key):
                stack.pop()
            if not is_url:
                if not stack or stack[-1].key != key:
                    stack.append(_Open(key))
                stack[-1].add(path, rule, verdict)
                continue
            fits = [r for o in stack if (r := o.best(path))]
            # the stack is in order of host length, so the last of equally long rules has the longer host
            won = max(enumerate(fits), key=lambda x: (len(x[1][0]), x[0]))[1] if fits else (None, default)
            out.append((page_id, host, path, *won))
        cols = list(zip(*out, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), *(pa.array(c, pa.string()) for c in cols[1:])],
            names=["page_id", "host", "path", "rule", "verdict"],
        )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``;
    ``rules`` has (host, path, verdict) and may be large."""
    spark = pages.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = save(
        urls.withColumn("key", host_key(F.col("host")))
        .repartitionByRange(n, "key", F.xxhash64("page_id"), "page_id")
        .withColumn("pid", F.spark_partition_id()),
        "urls",
    )
    # one row per partition
    bounds = urls.groupBy("pid").agg(F.min("key"), F.max("key")).collect()
    bounds = sorted((lo, hi, pid) for pid, lo, hi in bounds)
    firsts, lasts, pids = [b[0] for b in bounds], [b[1] for b in bounds], [b[2] for b in bounds]

    def place(batches):
        for b in batches:
            rows = [
                (p, key, host, path, host + path, verdict)
                for key, host, path, verdict in zip(*(c.to_pylist() for c in b.columns), strict=True)
                for p in pids[bisect_left(lasts, key) : bisect_right(firsts, key + _TOP)]
            ]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), *(pa.array(c, pa.string()) for c in cols[1:])],
                names=["pid", "key", "host", "path", "rule", "verdict"],
            )

    placed = (
        rules.select("host", "path", "verdict")
        .where((F.length("host") > 0) & F.col("path").isNotNull())
        .select(host_key(F.col("host")).alias("key"), "host", "path", "verdict")
        .distinct()
        .mapInArrow(place, "pid int, key string, host string, path string, rule string, verdict string")
    )
    events = urls.select(
        "pid", "key", F.lit(True).alias("is_url"), "page_id", "host", "path",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"),
    ).union(
        placed.select("pid", "key", F.lit(False), F.lit(None).cast("long"), "host", "path", "rule", "verdict")
    )
    return (
        events.repartitionByRange(n, "pid")
        .sortWithinPartitions("pid", "key", "is_url")
        .mapInArrow(lambda batches: _sweep(batches, default), _OUT)
    )
