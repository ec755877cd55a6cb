"""Splitting a table into parts of bounded size: by number of rows, and by size at the boundaries of keys.

A part's number is a column; to get a file for each, write partitioned by it. Numbers come from running sums over written ranges, so no
task sees more than its own range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import digest_number
from .running import accumulated, join_groups, ranges


def chunks(rows: DataFrame, order: list[str], size: int, share: float = 1.0, ids: list[str] | None = None, seed: int = 42) -> DataFrame:
    """Add ``chunk_no`` from 1: parts of ``size`` rows, in a total order, of all rows or of about ``share`` of them.

    The last part has the rest. The sampled rows are those of least digest of their ``ids``, the same in every run; both mates
    of a pair are taken or left if they have one id.
    """
    if size < 1:
        raise ValueError("a chunk has at least one row")
    kept = rows if share >= 1 else rows.filter(digest_number(*(ids or order), seed=seed) < int(share * 2**32))
    by = [F.asc(c) for c in order]
    placed = accumulated(ranges(kept, [], by), [], by, "__no", "sum", F.lit(1))
    return placed.withColumn("chunk_no", (F.floor((F.col("__no") - 1) / size) + 1).cast("int")).drop("__no", "__part")


def parts_of(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """Add ``part_no`` from 1 to ``n``: parts whose numbers of rows differ by at most one, in a total order."""
    if n < 1:
        raise ValueError("there is at least one part")
    by = [F.asc(c) for c in order]
    placed = accumulated(ranges(rows, [], by), [], by, "__no", "sum", F.lit(1))
    total = placed.count()
    return placed.withColumn("part_no", (F.floor((F.col("__no") - 1) * n / max(total, 1)) + 1).cast("int")).drop("__no", "__part")


def on_key_boundaries(rows: DataFrame, key: str, weight: Column, target: float) -> DataFrame:
    """Add ``part_no`` from 1: in order of the key, rows of one key stay together, and a part ends with the key at which the sum of
    weights passes a multiple of ``target``.

    Keys are folded to their weights before they are put in order, so a key of any size is one row there. A null key comes first.
    """
    if target <= 0:
        raise ValueError("the target is above 0")
    sizes = rows.groupBy(key).agg(F.sum(weight).alias("__w"))
    by = [F.asc_nulls_first(key)]
    placed = accumulated(ranges(sizes, [], by), [], by, "__upto", "sum", F.coalesce("__w", F.lit(0)))
    part = (F.floor((F.col("__upto") - F.coalesce("__w", F.lit(0))) / F.lit(target)) + 1).cast("int")
    return join_groups(rows, placed.select(key, part.alias("part_no")), [key])
