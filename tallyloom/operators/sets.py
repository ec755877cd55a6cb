"""Sampling, pivots, sets and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import digest_number
from ..session import materialize
from .joins import bounded
from .running import join_groups, numbered


def sample_exactly(df: DataFrame, ids: list[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer), by the least hashes of their ids: the same for any partitioning."""
    return df.orderBy(F.xxhash64(*ids, F.lit(seed)), *ids).limit(n)


def sample_share(df: DataFrame, ids: list[str], share: float, seed: int = 42) -> DataFrame:
    """About ``share`` of the rows, by a hash of their ids; no shuffle."""
    return df.filter(digest_number(*ids, seed=seed) < int(share * 2**32))


def sample_by_group(df: DataFrame, group: str, ids: list[str], share: float, seed: int = 42) -> DataFrame:
    """``ceil(share n)`` rows of each group, by least hash. A group's rows are numbered over ranges of their hashes, so it may be of any size."""
    order = [F.xxhash64(*ids, F.lit(seed)), *[F.col(c) for c in ids]]
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("__size"))
    placed = join_groups(numbered(df, [group], order, "__k"), sizes, [group])
    return placed.filter(F.col("__k") <= F.ceil(F.col("__size") * share)).drop("__k", "__size")


def pivot(df: DataFrame, index: str, column: str, values: list[str], value: Column, fill: object = None) -> DataFrame:
    """Wide table over a given list of columns: one pass, since the list is known."""
    out = df.groupBy(index).pivot(column, values).agg(value)
    return out if fill is None else out.fillna(fill)


def stack(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables; columns that one lacks are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def combinations(members: DataFrame, set_id: str, item: str) -> DataFrame:
    """How many items belong to exactly each combination of sets. The number of sets is small; an item's list of them is bounded by it."""
    by_item = members.select(set_id, item).dropna().distinct().groupBy(item).agg(F.array_join(F.sort_array(F.collect_set(F.col(set_id).cast("string"))), "&").alias("combination"))
    return by_item.groupBy("combination").agg(F.count(F.lit(1)).alias("n_items"))


def jaccard(members: DataFrame, set_id: str, item: str, limit: int = 5_000) -> DataFrame:
    """``set_a < set_b, both, jaccard`` of the sets that share an item.

    By an inverted index: a join on the item gives the pairs of the sets that hold it. It is for few sets (clusters, conditions,
    gene lists), which bounds the pairs of an item: more than ``limit`` are an error. Sets are made distinct and sized by aggregates.
    """
    bounded(members, set_id, limit)
    m = materialize(members.select(F.col(set_id).alias("s"), F.col(item).alias("i")).dropna().distinct(), "members")
    held = m.select("i", F.col("s").alias("set_a")).join(m.select("i", F.col("s").alias("set_b")), "i").filter("set_a < set_b")
    both = held.groupBy("set_a", "set_b").agg(F.count(F.lit(1)).alias("both"))
    size = m.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    out = both.join(size.select(F.col("s").alias("set_a"), F.col("n").alias("n_a")), "set_a").join(size.select(F.col("s").alias("set_b"), F.col("n").alias("n_b")), "set_b")
    return out.select("set_a", "set_b", "both", (F.col("both") / (F.col("n_a") + F.col("n_b") - F.col("both"))).alias("jaccard"))


def in_fixed_order(df: DataFrame, key: str, first: list[str], last: list[str]) -> DataFrame:
    """``place``: rows named in ``first`` before, those in ``last`` after all others, which are in order of the key."""
    from pyspark.sql import Window

    rank = lambda names: F.element_at(F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))]), F.col(key))
    group = F.when(F.col(key).isin(first), 0).when(F.col(key).isin(last), 2).otherwise(1)
    return df.withColumn("place", F.row_number().over(Window.orderBy(group, F.coalesce(rank(first), rank(last), F.lit(0)), key)))
