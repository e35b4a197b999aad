"""Greatest text per group without sorting rows.

A maximum of strings has no fixed-width buffer, so Spark sorts the raw rows by
group to compute it.  Here the distinct texts of the column are listed first
(a partial aggregate of one column); while there are few, each row carries its
text's rank, an integer that a hash aggregate folds.  Many or long texts are
folded per (group, text) first, again by a hash aggregate, and only those folded
rows are reduced to the greatest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts that are ranked at most, and their bytes; both bound what is listed.
MAX_TEXTS = 64
MAX_BYTES = 1_024

_RANK = "_text_rank"


def distinct_texts(df: DataFrame, text: str) -> list[str] | None:
    """The column's distinct texts in byte order, or None if there are more
    than ``MAX_TEXTS`` or one is longer than ``MAX_BYTES``."""
    fits = F.octet_length(text) <= MAX_BYTES
    listed = df.where(F.col(text).isNotNull()).select(F.when(fits, F.col(text)).alias("text")).distinct()
    found = [r["text"] for r in listed.limit(MAX_TEXTS + 1).collect()]
    if len(found) > MAX_TEXTS or None in found:
        return None
    return sorted(found, key=str.encode)


def greatest_text(df: DataFrame, keys: list[str], text: str, **maxima: Column) -> DataFrame:
    """(*keys, text, *maxima): per group the greatest ``text`` in byte order
    (null if it has none) and the greatest value of each of ``maxima``."""
    greatest = [F.max(value).alias(name) for name, value in maxima.items()]
    texts = distinct_texts(df, text)
    if texts is None:
        folded = df.groupBy(*keys, text).agg(*greatest)
        return folded.groupBy(*keys).agg(F.max(text).alias(text), *(F.max(n).alias(n) for n in maxima))
    if not texts:
        return df.groupBy(*keys).agg(*greatest).select(*keys, F.lit(None).cast("string").alias(text), *maxima)
    known = F.lit(texts)
    rank = F.array_position(known, F.col(text)).cast("int")
    # a text that came after the listing must not pass as none
    checked = F.when(rank == 0, F.raise_error(F.lit(f"{text}: texts were added while they were read")).cast("int")).otherwise(rank)
    grouped = df.groupBy(*keys).agg(F.max(checked).alias(_RANK), *greatest)
    return grouped.select(*keys, F.get(known, F.col(_RANK) - 1).alias(text), *maxima)
