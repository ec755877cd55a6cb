"""Running sums, numbers and least values over ordered groups of any size.

A window by a group puts the whole group into one task. Here the rows are range-partitioned by group and order and written, so that
a large group lies over many ranges; what the earlier ranges of a group hold is one row per group and range, accumulated first; and each
range then adds up only its own rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_AGGREGATES = {"sum": F.sum, "min": F.min, "max": F.max}


def join_groups(df: DataFrame, per_group: DataFrame, group: list[str]) -> DataFrame:
    """``df`` with the other columns of ``per_group``, which has one row for each of its groups, also for a null one.

    Without a group it is one row, which is read back.
    """
    if not group:
        row = per_group.first()
        return df.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in per_group.schema})
    named = per_group.select(*[F.col(g).alias(f"__g{k}") for k, g in enumerate(group)], *[c for c in per_group.columns if c not in group])
    same = reduce(lambda x, y: x & y, [F.col(g).eqNullSafe(F.col(f"__g{k}")) for k, g in enumerate(group)])
    return df.join(named, same).drop(*[f"__g{k}" for k in range(len(group))])


def ranges(df: DataFrame, group: list[str], order: list[Column], parts: int | None = None) -> DataFrame:
    """``df`` in ranges of its groups' order, written, with the number of each row's range in ``__part``.

    There are ``parts`` ranges, by default as many as the size of the data asks for.
    """
    by = [*[F.col(g) for g in group], *order]
    laid = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    return materialize(laid.withColumn("__part", F.spark_partition_id()), "ranges")


def accumulated(laid: DataFrame, group: list[str], order: list[Column], out: str, kind: str, value: Column, backwards: bool = False) -> DataFrame:
    """Add ``out``: the ``sum``, ``min`` or ``max`` of ``value`` over a group's rows up to and including this one.

    ``laid`` is what ``ranges`` gave, perhaps with more columns; ``order`` sorts within a range. With ``backwards``, ``order`` is the reverse
    of that of the ranges, and the last range comes first.
    """
    agg = _AGGREGATES[kind]
    rows = laid.withColumn("__v", value)
    own = rows.groupBy(*group, "__part").agg(agg("__v").alias("__own"))
    earlier = Window.partitionBy(*group).orderBy(F.desc("__part") if backwards else F.asc("__part")).rowsBetween(Window.unboundedPreceding, -1)
    before = own.select(*group, "__part", agg("__own").over(earlier).alias("__before"))
    within = Window.partitionBy(*group, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    both = join_groups(rows.withColumn("__within", agg("__v").over(within)), before, [*group, "__part"])
    total = F.coalesce("__before", F.lit(0)) + F.col("__within") if kind == "sum" else (F.least if kind == "min" else F.greatest)("__before", "__within")
    return both.withColumn(out, total).drop("__v", "__within", "__before")


def numbered(df: DataFrame, group: list[str], order: list[Column], out: str) -> DataFrame:
    """Add ``out``: the number of each row in its group, from 1, in a total order."""
    return accumulated(ranges(df, group, order), group, order, out, "sum", F.lit(1)).drop("__part")
