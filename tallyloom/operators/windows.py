"""Windows, ranks and order-dependent numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import digest_number
from .running import accumulated, join_groups, ranges


def running_total(df: DataFrame, value: str, tie: str, least: float = 1) -> DataFrame:
    """``place`` and ``cum`` of the values above ``least``, greatest first; equal values in order of the tie column."""
    order = [F.desc(value), F.asc(tie)]
    laid = ranges(df.filter(F.col(value) > least).select(tie, value), [], order)
    placed = accumulated(laid, [], order, "place", "sum", F.lit(1))
    return accumulated(placed, [], order, "cum", "sum", F.col(value)).drop("__part")


def log_log_slope(place: str = "place", cum: str = "cum") -> Column:
    """Slope of log10(cum) over log10(place), by least squares."""
    return F.regr_slope(F.log10(cum), F.log10(place))


def dispersion(expression: DataFrame, gene: str, value: str, n_cells: int) -> DataFrame:
    """Mean, variance and dispersion of log10(value + 1) per gene, over ``n_cells`` cells.

    The mean counts absent cells as zeros. The variance is the sum over the cells present only, of the squared distance
    from that mean, over n_cells - 1. Where the mean isn't above 0 both are 0. From algebraic sums, in one pass.
    """
    x = F.log10(F.col(value) + 1)
    s = expression.groupBy(gene).agg(F.sum(x).alias("s"), F.sum(x * x).alias("q"), F.count(x).alias("n"))
    mean = F.col("s") / n_cells
    var = (F.col("q") - 2 * mean * F.col("s") + F.col("n") * mean * mean) / F.lit(n_cells - 1)
    return s.select(gene, mean.alias("mean"), F.when(mean > 0, var).otherwise(0.0).alias("variance"), F.when(mean > 0, var / mean).otherwise(0.0).alias("dispersion"))


def equal_bins(df: DataFrame, order: list[str], bins: int = 20, out: str = "bin", last_takes_rest: bool = True) -> DataFrame:
    """Bins of equally many rows in the given order; a remainder goes to the last bin, or (else) as ``ntile`` spreads it.

    For rows that are few by nature (one per gene): the ranks come from one window over them.
    """
    w = Window.orderBy(*order)
    if not last_takes_rest:
        return df.withColumn(out, F.ntile(bins).over(w) - 1)
    n = F.count(F.lit(1)).over(Window.partitionBy())
    size = F.bround(n / bins, 0)
    no = F.row_number().over(w) - 1
    return df.withColumn(out, F.when(n < bins, 0).otherwise(F.least(F.floor(no / size), F.lit(bins - 1))).cast("int"))


def z_in_bins(df: DataFrame, value: str, group: str, population: bool = False) -> DataFrame:
    """``z``: distance from the group's mean in standard deviations; null where that is 0 or undefined."""
    return _z(df, [group], value, "z", F.stddev_pop if population else F.stddev_samp)


def _z(df: DataFrame, group: list[str], value: str, out: str, deviation: Callable) -> DataFrame:
    """Mean and deviation are an aggregate, one row per group, joined back: a group of any size is folded where its rows are."""
    stats = df.groupBy(*group).agg(F.avg(value).alias("__mean"), deviation(value).alias("__sd"))
    z = F.try_divide(F.col(value) - F.col("__mean"), F.nullif(F.col("__sd"), F.lit(0.0)))
    return join_groups(df, stats, group).withColumn(out, z).drop("__mean", "__sd")


def variable_genes(stats: DataFrame, gene: str = "gene", bins: int = 20, cutoff: float = 1.7) -> DataFrame:
    """Genes whose dispersion stands out (z at least ``cutoff``) among those of about the same mean."""
    binned = equal_bins(stats.filter("mean > 0"), ["mean", gene], bins)
    return z_in_bins(binned, "dispersion", "bin").filter(F.col("z") >= cutoff)


def under_represented(totals: DataFrame, gene: str, all_reads: str, kept_reads: str, panel_size: int, k: float) -> DataFrame:
    """Genes with more reads outside the kept cells than a line of slope 1 (in logs) tells.

    The line's intercept divides by the panel's size, not by the rows. A gene is taken if its residual is above
    the median by more than ``k`` sample standard deviations. The line and the spread are one
    row of aggregates, read back as numbers.
    """
    y, x = F.log10(F.col(all_reads) + 1), F.log10(F.col(kept_reads) + 1)
    d = totals.select(gene, (y - x).alias("d"))
    c, m, s = d.agg(F.sum("d") / panel_size, F.median("d"), F.stddev_samp("d")).first()
    if s is None:
        return d.select(gene, F.col("d").alias("residual")).limit(0)
    return d.select(gene, (F.col("d") - c).alias("residual")).filter(F.col("residual") > (m - c) + k * s)


def count_threshold(totals: DataFrame, value: str, share: float = 0.005) -> DataFrame:
    """One row, ``threshold``: the greatest value such that all rows up to it hold at most ``share`` of the sum; 0 if none."""
    bars = totals.groupBy(F.col(value).alias("v")).agg(F.sum(value).alias("s"))
    w = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return bars.withColumn("f", F.sum("s").over(w) / F.sum("s").over(Window.partitionBy())).agg(F.coalesce(F.max(F.when(F.col("f") <= share, F.col("v"))), F.lit(0)).alias("threshold"))


def largest_drop(totals: DataFrame, value: str, tie: str) -> DataFrame:
    """One row: where the last quarter of the totals, greatest first, falls most: ``cutoff`` and ``jump``."""
    w = Window.orderBy(F.desc(value), tie)
    n = F.count(F.lit(1)).over(Window.partitionBy())
    ranked = totals.select(F.col(value).alias("v"), F.row_number().over(w).alias("k"), n.alias("n"), F.lead(value).over(w).alias("after"))
    quarter = ranked.filter((F.col("k") > F.col("n") - F.ceil(F.col("n") / 4)) & F.col("after").isNotNull())
    first = F.struct((F.col("after") - F.col("v")).alias("d"), F.col("k"))
    return quarter.agg(F.min_by("v", first).alias("cutoff"), F.min_by(F.col("v") - F.col("after"), first).alias("jump"))


def best_per_group(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in a total order."""
    return df.withColumn("__k", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("__k") == 1).drop("__k")


def most_frequent(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """The most frequent value of each group, the smallest on ties; counted before anything is ranked."""
    n = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))
    return best_per_group(n, group, [F.desc("n"), F.asc(value)])


def top_with_ties(df: DataFrame, group: list[str], value: str, n: int) -> DataFrame:
    """The rows of the ``n`` greatest values of each group, all that tie with the last included."""
    w = Window.partitionBy(*group).orderBy(F.desc(value))
    return df.withColumn("rank_no", F.rank().over(w)).filter(F.col("rank_no") <= n)


def scaled(df: DataFrame, group: list[str], value: str, out: str = "z") -> DataFrame:
    """z-score within the group, with the sample deviation; null where it is 0."""
    return _z(df, group, value, out, F.stddev_samp)


def without_outliers(df: DataFrame, group: list[str], value: str, m: float) -> DataFrame:
    """Rows closer than ``m`` median absolute deviations to the group's median; a deviation of 0 counts as 1.

    The medians are one row per group, from aggregates, joined back.
    """
    med = df.groupBy(*group).agg(F.median(value).alias("__m"))
    d = df.join(med, group).withColumn("__d", F.abs(F.col(value) - F.col("__m")))
    mad = d.groupBy(*group).agg(F.median("__d").alias("__s"))
    keep = F.col("__d") / F.when(F.col("__s") == 0, 1.0).otherwise(F.col("__s")) < m
    return d.join(mad, group).filter(keep).drop("__m", "__d", "__s")


def is_outlier(df: DataFrame, group: list[str], value: str, n_mads: float, lower: bool = True, upper: bool = False, log: bool = False) -> DataFrame:
    """``outlier``: beyond ``n_mads`` scaled median absolute deviations of the batch, below or above."""
    x = F.log(F.col(value)) if log else F.col(value).cast("double")
    d = df.withColumn("__x", x)
    med = d.groupBy(*group).agg(F.median("__x").alias("__m"))
    d = d.join(med, group)
    mad = d.groupBy(*group).agg((1.4826 * F.median(F.abs(F.col("__x") - F.col("__m")))).alias("__s"))
    low = F.col("__x") < F.col("__m") - n_mads * F.col("__s") if lower else F.lit(False)
    high = F.col("__x") > F.col("__m") + n_mads * F.col("__s") if upper else F.lit(False)
    return d.join(mad, group).withColumn("outlier", low | high).drop("__x", "__m", "__s")


def adjust_p(df: DataFrame, p: str, group: list[str] | None = None, out: str = "q") -> DataFrame:
    """Benjamini-Hochberg: least p n / rank over all greater p, at most 1, within each family of tests."""
    by = group or []
    bars = df.filter(F.col(p).isNotNull()).groupBy(*by, p).agg(F.count(F.lit(1)).alias("__n"))
    ranked = accumulated(ranges(bars, by, [F.asc(p)]), by, [F.asc(p)], "__rank", "sum", F.col("__n"))
    whole = ranked.groupBy(*by).agg(F.sum("__n").alias("__all"))
    raw = join_groups(ranked, whole, by).withColumn("__raw", F.col(p) * F.col("__all") / F.col("__rank"))
    least = accumulated(raw, by, [F.desc(p)], "__q", "min", F.col("__raw"), backwards=True)
    found = least.select(*by, p, F.least(F.lit(1.0), "__q").alias(out))
    return join_groups(df.filter(F.col(p).isNotNull()).drop(out), found, [*by, p])


def clipped(df: DataFrame, value: str, share: float = 0.99) -> DataFrame:
    """``clipped``: the value bound by the given percentile of its magnitude."""
    top = F.lit(df.agg(F.percentile(F.abs(value), share)).first()[0])
    return df.withColumn("clipped", F.greatest(-top, F.least(top, F.col(value))))


def saturation_curve(reads: DataFrame, read_id: str, gene: str, steps: int = 100, seed: int = 7) -> DataFrame:
    """``step, depth, detected``: reads and distinct genes among the first k of ``steps`` random parts of the reads.

    A read's part is a hash of its id. A gene is new in the least part that has a read of it, so the distinct genes so
    far are a running sum over one row per part; no set of genes is kept.
    """
    part = F.pmod(digest_number(read_id, seed=seed), F.lit(steps)).cast("int")
    counted = reads.groupBy(part.alias("step"), gene).agg(F.count(F.lit(1)).alias("n"))
    depth = counted.groupBy("step").agg(F.sum("n").alias("n"))
    fresh = counted.filter(F.col(gene).isNotNull()).groupBy(gene).agg(F.min("step").alias("step")).groupBy("step").agg(F.count(F.lit(1)).alias("g"))
    w = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    both = depth.join(fresh, "step", "full_outer").fillna(0)
    return both.select("step", F.sum("n").over(w).alias("depth"), F.sum("g").over(w).alias("detected"))
