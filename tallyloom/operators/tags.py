"""Calling the sample tag of each cell."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import sized_broadcast
from .windows import without_outliers

# Parameters of the tag call.
GOOD_SHARE, GOOD_COUNT = 0.75, 30
NOISE_MADS, SIGNAL_MADS = 12.0, 4.0
LOWEST, SLACK, LIFT = 100, 0.75, 1.5
LEAST_RELATIVE, LEAST_COUNT = 0.2, 5


def singletons(counts: DataFrame, cell: str = "cell", tag: str = "tag", n: str = "n") -> DataFrame:
    """``counts`` with each cell's total and top tag, and whether one tag dominates it (``is_good``).

    ``counts`` has one row per cell and tag, zeros left out or not. The first tag in order wins a tie. Per cell the
    total and the top come from one aggregate; a cell has at most as many rows as there are tags.
    """
    top = counts.groupBy(cell).agg(F.sum(n).alias("total"), F.min(F.struct((-F.col(n)).alias("c"), F.col(tag).alias("t"))).alias("x"))
    per = top.select(cell, "total", F.col("x.t").alias("top_tag"), (-F.col("x.c")).alias("top_n"))
    good = (F.col("top_n") > GOOD_SHARE * F.col("total")) & (F.col("top_n") >= GOOD_COUNT)
    return counts.join(per.withColumn("is_good", good), cell)


def noise_counts(marked: DataFrame, tag: str = "tag", n: str = "n") -> DataFrame:
    """Counts of other tags in well-called cells, without outliers: ``tag, n``."""
    noise = marked.filter(F.col("is_good") & (F.col(tag) != F.col("top_tag")) & (F.col(n) > 0))
    return without_outliers(noise.select(tag, n), [tag], n, NOISE_MADS)


def good_thresholds(marked: DataFrame, noise: DataFrame, tag: str = "tag", n: str = "n") -> DataFrame:
    """``tag, n_good, min_good``: the least count that speaks for the tag.

    Three quarters of the least of the hundred lowest good counts, outliers left out; if that is below the greatest noise
    count, that times one and a half. Tags without good cells have no row.
    """
    good = marked.filter(F.col("is_good") & (F.col(tag) == F.col("top_tag"))).select(tag, n)
    w = Window.partitionBy(tag).orderBy(n)
    low = good.withColumn("__k", F.row_number().over(w)).filter(F.col("__k") <= LOWEST).drop("__k")
    least = without_outliers(low, [tag], n, SIGNAL_MADS).groupBy(tag).agg((F.min(n) * SLACK).alias("low"))
    top = noise.groupBy(tag).agg(F.max(n).alias("top"))
    size = good.groupBy(tag).agg(F.count(F.lit(1)).alias("n_good"))
    return size.join(least, tag).join(top, tag, "left").select(tag, "n_good", F.when(F.col("low") < F.col("top"), F.col("top") * LIFT).otherwise(F.col("low")).alias("min_good"))


def noise_shares(noise: DataFrame, thresholds: DataFrame, tag: str = "tag", n: str = "n") -> DataFrame:
    """``tag, noise_share``: its part of all noise below the tags' thresholds. The window is over one row per tag."""
    kept = noise.join(thresholds, tag).filter(F.col(n) < F.col("min_good")).groupBy(tag).agg(F.sum(n).alias("s"))
    return kept.select(tag, (F.col("s") / F.sum("s").over(Window.partitionBy())).alias("noise_share"))


def noise_slope(marked: DataFrame, cell: str = "cell") -> float:
    """Noise per count of a well-called cell: least squares through the origin, from two sums."""
    per = marked.filter("is_good").groupBy(cell).agg(F.first("total").alias("x"), F.first(F.col("total") - F.col("top_n")).alias("y"))
    return per.agg(F.coalesce(F.try_divide(F.sum(F.col("x") * F.col("y")), F.sum(F.col("x") * F.col("x"))), F.lit(0.0)).cast("double")).first()[0]


@dataclass
class TagCalls:
    """``calls``: cell, sample_tag, tags; ``status``: one row per tag."""

    calls: DataFrame
    status: DataFrame


def call_tags(counts: DataFrame, cells: DataFrame, cell: str = "cell", tag: str = "tag", n: str = "n") -> TagCalls:
    """The tag of every cell in ``cells``: one tag, ``Multiplet`` or ``Undetermined``.

    Expected noise is taken off each count (the tag's share of the noise that the cell's total foretells, rounded half to even).
    What then reaches the tag's threshold is a call. A cell without any takes the tag with the
    greatest count relative to its threshold, if that is above 0.2 and the count at least 5.
    """
    known = counts.join(cells.select(cell).distinct(), cell, "left_semi").select(cell, tag, n)
    marked = materialize(singletons(known, cell, tag, n), "tag-counts")
    noise = materialize(noise_counts(marked, tag, n), "tag-noise")
    thresholds = good_thresholds(marked, noise, tag, n)
    shares = noise_shares(noise, thresholds, tag, n)
    per_tag = materialize(thresholds.join(shares, tag, "left").fillna(0.0, ["noise_share"]), "tag-thresholds")
    slope = noise_slope(marked, cell)
    x = marked.join(sized_broadcast(per_tag), tag)
    corrected = F.greatest(F.col(n) - F.bround(F.col("noise_share") * F.lit(slope) * F.col("total"), 0), F.lit(0.0))
    x = x.select(cell, tag, corrected.alias("c"), "min_good").withColumn("rel", F.col("c") / F.col("min_good"))
    hit = F.when(F.col("c") >= F.col("min_good"), F.col(tag))
    fallback = F.when((F.col("c") >= LEAST_COUNT) & (F.col("rel") > LEAST_RELATIVE), F.struct((-F.col("rel")).alias("r"), F.col(tag).alias("t")))
    per = x.groupBy(cell).agg(F.sort_array(F.collect_list(hit)).alias("hits"), F.min(fallback).alias("best"))
    tags = F.when(F.size("hits") > 0, F.col("hits")).when(F.col("best").isNotNull(), F.array("best.t")).otherwise(F.array().cast("array<string>"))
    named = cells.select(cell).distinct().join(per.select(cell, tags.alias("t")), cell, "left").withColumn("t", F.coalesce("t", F.array().cast("array<string>")))
    label = F.when(F.size("t") == 0, "Undetermined").when(F.size("t") > 1, "Multiplet").otherwise(F.try_element_at("t", F.lit(1)))
    return TagCalls(named.select(cell, label.alias("sample_tag"), F.array_join("t", ";").alias("tags")), per_tag)


def tag_name(text: str) -> tuple[str, str]:
    """``4-Ramos`` to its number and name. A missing or second ``-``, or a character other than letters, digits, ``_`` in the name, is an error."""
    number, dash, name = text.partition("-")
    if not dash or not number.strip().isdigit() or "-" in name or not name or not all(c.isalnum() or c == "_" for c in name):
        raise ValueError(f"not a tag name: {text!r}")
    return number.strip(), name
