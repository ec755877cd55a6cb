"""Joins beyond the plain ones: by interval, by likeness, to a domain, by position."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, parallelism

BROADCAST_ROWS = 100_000


def sized_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows, by a count that stops there; else as it is."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def bounded(df: DataFrame, key: str, limit: int) -> None:
    """An error if ``key`` has more than ``limit`` values: for operators whose result has a row for every two of them."""
    if df.select(key).distinct().limit(limit + 1).count() > limit:
        raise ValueError(f"{key} has more than {limit} values; pairs of so many aren't compared")


def join_by_id(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of two files that belong together, by an id given when they were read.

    Stands for pairing by position: a row without a partner, or an id that repeats, is an error rather than a
    silent shift. The check is one aggregate over the joined rows.
    """
    both = left.withColumn("__l", F.lit(1)).join(right.withColumn("__r", F.lit(1)), key, "full_outer")
    whole = F.when(F.col("__l").isNotNull() & F.col("__r").isNotNull(), F.lit(True)).otherwise(F.raise_error(F.lit("rows without a partner")).cast("boolean"))
    return both.filter(whole).drop("__l", "__r")


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], tasks: int | None = None) -> DataFrame:
    """Inner join on ``keys`` when a key may hold a large part of ``left``.

    A key with more than a task's equal share of ``left`` is split by a hash of the row into as many parts as it has shares, and the rows of
    ``right`` with that key are laid out for each part. There are fewer such keys than tasks, which bounds what is broadcast. The keys
    of ``left`` are counted first, so it is read twice.
    """
    spark = left.sparkSession
    tasks = tasks or parallelism(spark)
    counts = materialize(left.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")), "key-counts")
    total = counts.agg(F.sum("__n")).first()[0] or 0
    heavy = counts.filter(F.col("__n") * F.lit(tasks) > F.lit(total)).select(*keys, F.ceil(F.col("__n") * F.lit(tasks) / F.lit(max(total, 1))).cast("int").alias("__parts"))
    if not total or heavy.limit(1).count() == 0:
        return left.join(right, keys)
    heavy = F.broadcast(heavy)
    parts = F.coalesce("__parts", F.lit(1))
    a = left.join(heavy, keys, "left").withColumn("__salt", F.pmod(F.xxhash64(*left.columns), parts).cast("int")).drop("__parts")
    b = right.join(heavy, keys, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return a.join(b, [*keys, "__salt"]).drop("__salt")


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], width: int, left_span: tuple[str, str] = ("start", "end"), right_span: tuple[str, str] = ("f_start", "f_end")) -> DataFrame:
    """Pairs whose closed intervals overlap, within equal ``keys``: an equi-join on bins, not a comparison of all pairs.

    Each interval is filed under the bins of ``width`` that it touches; a pair is kept in the bin where the later of
    the two starts lies, so it comes once and nothing is made distinct afterwards. A bin with a pile of left intervals is split
    (``salted_join``). Choose ``width`` near the usual length: an interval is copied once per bin. Intervals with a null end, or that end before they start, match nothing.
    """
    (ls, le), (rs, re_) = left_span, right_span
    binned = lambda d, s, e: d.filter(F.col(s) <= F.col(e)).withColumn("__bin", F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.col(e) / width))))
    a, b = binned(left, ls, le), binned(right, rs, re_)
    met = salted_join(a, b, [*keys, "__bin"]).filter((F.col(ls) <= F.col(re_)) & (F.col(rs) <= F.col(le)))
    return met.filter(F.col("__bin") == F.floor(F.greatest(ls, rs) / width)).drop("__bin")


def assign_features(blocks: DataFrame, features: DataFrame, read: str, width: int = 10_000) -> DataFrame:
    """``read, feature, tier``: each read's feature by the first tier that gives one.

    ``blocks``: read, chrom, strand, start, end; ``features``: chrom, f_strand, f_start, f_end, feature, kind (``exon`` or ``intron``). Tiers: exon,
    intron, exon of the other strand, intron of the other strand, none. More than one feature in the deciding tier is
    ``ambiguous``; no feature at all is ``no_feature``.
    """
    met = overlap_join(blocks, features, ["chrom"], width)
    same = F.col("strand") == F.col("f_strand")
    tier = F.when(same & (F.col("kind") == "exon"), 1).when(same, 2).when(F.col("kind") == "exon", 3).otherwise(4)
    found = met.select(read, "feature", tier.alias("tier")).groupBy(read).agg(F.min(F.struct("tier", "feature")).alias("first"), F.min("tier").alias("tier"), F.collect_set(F.struct("tier", "feature")).alias("all"))
    n = F.size(F.filter("all", lambda x: x["tier"] == F.col("tier")))
    names = found.select(read, F.when(n > 1, "ambiguous").otherwise(F.col("first.feature")).alias("feature"), "tier")
    every = blocks.select(read).distinct()
    return every.join(names, read, "left").select(read, F.coalesce("feature", F.lit("no_feature")).alias("feature"), F.coalesce("tier", F.lit(5)).alias("tier"))


def nearest_whitelisted(values: DataFrame, col: str, whitelist: list[str], limit: int) -> DataFrame:
    """Distinct values with ``place`` (1-based in the whitelist, null without a call) and ``distance``.

    Exact members are looked up. The others are compared with the fixed whitelist by a bounded edit distance: the
    unique nearest within ``limit`` is the call; a tie, or two at distance 1, is none. The whitelist is a
    literal array, so there is no join; values are made distinct first.
    """
    words = F.array(*[F.lit(w) for w in whitelist])
    distinct = values.select(col).filter(F.col(col).isNotNull()).distinct()
    scored = F.transform(words, lambda w: F.levenshtein(F.col(col), w, limit))
    known = F.filter(scored, lambda d: d >= 0)
    best = F.array_min(known)
    unique = F.size(F.filter(scored, lambda d: d == best)) == 1
    exact = F.array_position(words, F.col(col))
    place = F.when(exact > 0, exact).when(unique, F.array_position(scored, best))
    return distinct.withColumn("place", place.cast("int")).withColumn("distance", F.when(F.col("place").isNotNull(), F.when(exact > 0, 0).otherwise(best)))


def lookup(df: DataFrame, dim: DataFrame, on: list[str], fill: dict[str, Column] | None = None) -> DataFrame:
    """Left join to a dimension whose size is checked; missing values by ``fill``."""
    out = df.join(sized_broadcast(dim), on, "left")
    return out.withColumns({c: F.coalesce(F.col(c), v) for c, v in (fill or {}).items()})


def to_domain(df: DataFrame, domain: DataFrame, on: list[str], fill: dict[str, object]) -> DataFrame:
    """Every row of the domain once, with the values of ``df`` or the fill."""
    return domain.join(df, on, "left").fillna(fill)


def complete(df: DataFrame, a: str, b: str, fill: dict[str, object], limit: int = BROADCAST_ROWS) -> DataFrame:
    """Every combination of two keys' values, missing ones filled.

    The combinations are wanted as the result; ``b`` must have few values (at most ``limit``), which are
    gathered into one array and exploded beside each ``a``.
    """
    few = sorted(r[0] for r in df.select(b).filter(F.col(b).isNotNull()).distinct().limit(limit + 1).collect())
    if len(few) > limit:
        raise ValueError(f"{b} has more than {limit} values")
    domain = df.select(a).filter(F.col(a).isNotNull()).distinct().withColumn(b, F.explode(F.array(*[F.lit(x) for x in few])))
    return to_domain(df, domain, [a, b], fill)


def outer_join_all(tables: list[DataFrame], on: list[str], fill: object = 0) -> DataFrame:
    """Full outer join of several tables on their index, missing numbers filled."""
    return reduce(lambda x, y: x.join(y, on, "full_outer"), tables).fillna(fill)


def pairs_of(items: DataFrame, key: str, limit: int = 5_000) -> DataFrame:
    """``key_a < key_b`` for all pairs of a small set of items (clusters, conditions), whose size is checked."""
    few = sorted(r[0] for r in items.select(key).filter(F.col(key).isNotNull()).distinct().limit(limit + 1).collect())
    if len(few) > limit:
        raise ValueError(f"{key} has more than {limit} values")
    all_of = F.array(*[F.lit(x) for x in few])
    return items.select(F.col(key).alias("key_a")).filter("key_a IS NOT NULL").distinct().withColumn("key_b", F.explode(F.filter(all_of, lambda x: x > F.col("key_a")))) if few else items.select(F.col(key).alias("key_a"), F.col(key).alias("key_b")).limit(0)
