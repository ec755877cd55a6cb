"""Markers, enrichment, correlation, resampling and pathway scores."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, ship
from .joins import bounded, sized_broadcast

# ---------------------------------------------------------------- markers


def expression_shares(x: DataFrame, cluster: str, cell: str, gene: str, value: str, sizes: DataFrame) -> DataFrame:
    """Per cluster and gene: share of cells expressing it inside and outside, means, and the log2 ratio of means + 1e-9.

    ``sizes`` has the cells of each cluster (``cluster, n_cells``); absent entries are zeros. Sums inside come from one aggregate;
    those outside are the gene's total less them.
    """
    inside = x.filter(F.col(value) > 0).groupBy(cluster, gene).agg(F.count(F.lit(1)).alias("k"), F.sum(value).alias("s"))
    total = Window.partitionBy(gene)
    n_all = sizes.agg(F.sum("n_cells")).first()[0] or 0
    t = inside.withColumn("k_all", F.sum("k").over(total)).withColumn("s_all", F.sum("s").over(total)).join(sized_broadcast(sizes), cluster)
    n, rest = F.col("n_cells"), F.lit(n_all) - F.col("n_cells")
    mean_in, mean_out = F.col("s") / n, F.try_divide(F.col("s_all") - F.col("s"), rest)
    return t.select(cluster, gene, (F.col("k") / n).alias("pct_in"), F.try_divide(F.col("k_all") - F.col("k"), rest).alias("pct_out"), mean_in.alias("mean_in"), mean_out.alias("mean_out"), F.log2((mean_in + 1e-9) / (mean_out + 1e-9)).alias("log2_fc"))


def rank_sum(df: DataFrame, gene: str, group: str, value: str) -> DataFrame:
    """Wilcoxon's rank sum per gene between group true and the rest: U, z with tie correction."""
    from .matrix import average_ranks

    r = average_ranks(df, [gene], value)
    t = r.groupBy(gene, value).agg(F.count(F.lit(1)).alias("t")).groupBy(gene).agg(F.sum(F.col("t").cast("double") ** 3 - F.col("t")).alias("ties"))
    s = r.groupBy(gene).agg(F.coalesce(F.sum(F.when(F.col(group), F.col("rank_no"))), F.lit(0.0)).alias("r1"), F.count_if(F.col(group)).alias("n1"), F.count(F.lit(1)).alias("n"))
    n, n1 = F.col("n").cast("double"), F.col("n1").cast("double")
    n2 = n - n1
    u = F.col("r1") - n1 * (n1 + 1) / 2
    var = n1 * n2 / 12 * (n + 1 - F.try_divide(F.col("ties"), n * (n - 1)))
    return s.join(t, gene).select(gene, u.alias("u"), F.try_divide(u - n1 * n2 / 2, F.sqrt(var)).alias("z"))


@F.pandas_udf(T.DoubleType())
def normal_pvalue(z: pd.Series) -> pd.Series:
    """Two-sided p of a standard normal."""
    return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2)) if v is not None and v == v else None)


def cosine_scores(x: DataFrame, cluster: str, gene: str, value: str, sizes: DataFrame) -> DataFrame:
    """Cosine of each gene's expression with each cluster's indicator, and its share of the gene's squared cosines."""
    s = x.groupBy(cluster, gene).agg(F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("q"))
    g = Window.partitionBy(gene)
    cos = s.withColumn("q_all", F.sum("q").over(g)).join(sized_broadcast(sizes), cluster).withColumn("cosine", F.try_divide(F.col("s"), F.sqrt(F.col("q_all") * F.col("n_cells"))))
    c2 = F.col("cosine") * F.col("cosine")
    return cos.select(cluster, gene, "cosine", F.try_divide(c2, F.sum(c2).over(g)).alias("share"))


# ---------------------------------------------------------------- enrichment


def overlap_counts(query: DataFrame, sets: DataFrame, set_id: str, gene: str, background: DataFrame) -> DataFrame:
    """Per set: ``k`` genes of the query in it, ``n`` in the query, ``k_set`` in the set, ``n_all`` in the background; all within the background."""
    b = background.select(gene).distinct()
    q = query.select(gene).distinct().join(b, gene, "left_semi").withColumn("__q", F.lit(1))
    m = sets.select(set_id, gene).distinct().join(b, gene, "left_semi")
    n, big = q.count(), b.count()
    return m.join(q, gene, "left").groupBy(set_id).agg(F.count("__q").alias("k"), F.count(F.lit(1)).alias("k_set")).withColumn("n", F.lit(n).cast("bigint")).withColumn("n_all", F.lit(big).cast("bigint"))


def _tail(k: int, n: int, big_k: int, big_n: int) -> float:
    lc = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
    whole = lc(big_n, n)
    return min(1.0, sum(math.exp(lc(big_k, i) + lc(big_n - big_k, n - i) - whole) for i in range(k, min(n, big_k) + 1) if n - i <= big_n - big_k))


@F.pandas_udf(T.DoubleType())
def hypergeometric_tail(k: pd.Series, n: pd.Series, big_k: pd.Series, big_n: pd.Series) -> pd.Series:
    """P(at least k of n drawn genes are among the K of N)."""
    return pd.Series([_tail(*map(int, v)) for v in zip(k, n, big_k, big_n)])


def enrichment(query: DataFrame, sets: DataFrame, set_id: str, gene: str, background: DataFrame) -> DataFrame:
    """Over-representation of every set in the query: counts, p, adjusted p, and the ratio of the shares."""
    from .windows import adjust_p

    ship(query.sparkSession)
    c = overlap_counts(query, sets, set_id, gene, background).filter("k > 0")
    p = c.withColumn("p", hypergeometric_tail("k", "n", "k_set", "n_all")).withColumn("fold", (F.col("k") / F.col("n")) / (F.col("k_set") / F.col("n_all")))
    return adjust_p(p, "p")


def running_enrichment(ranked: DataFrame, sets: DataFrame, set_id: str, gene: str, score: str) -> DataFrame:
    """Per set: the enrichment score of a ranked list, the largest deviation of the running sum.

    Hits add their share of the set's absolute scores, misses take an equal step down. Only hits need to be walked
    along: between them the sum falls in a line, so its extremes lie at the hits and just before them.
    """
    order = Window.orderBy(F.desc(score), gene)
    r = materialize(ranked.select(gene, F.col(score).cast("double").alias("__s"), F.row_number().over(order).alias("__pos")), "ranked")
    n = r.count()
    hits = sets.select(set_id, gene).distinct().join(r, gene)
    per = Window.partitionBy(set_id)
    w = per.orderBy("__pos")
    h = hits.select(set_id, "__pos", F.abs("__s").alias("a"), F.row_number().over(w).alias("j"), F.count(F.lit(1)).over(per).alias("m"), F.sum(F.abs("__s")).over(per).alias("t"), F.sum(F.abs("__s")).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"))
    down = F.try_divide(F.col("__pos") - F.col("j"), F.lit(n) - F.col("m"))
    at, before = F.try_divide(F.col("c"), F.col("t")) - down, F.try_divide(F.col("c") - F.col("a"), F.col("t")) - down
    e = h.select(set_id, "m", at.alias("hi"), before.alias("lo")).groupBy(set_id).agg(F.max("hi").alias("hi"), F.min("lo").alias("lo"), F.first("m").alias("size"))
    return e.select(set_id, "size", F.when(F.col("hi") >= -F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("score"))


def distinct_sets(sets: DataFrame, set_id: str, gene: str) -> DataFrame:
    """Of sets with the same genes, the one with the greatest id."""
    lists = sets.select(set_id, gene).dropna().distinct().groupBy(set_id).agg(F.sort_array(F.collect_list(gene)).alias("genes"))
    return lists.groupBy("genes").agg(F.max(set_id).alias(set_id)).select(set_id, F.size("genes").alias("size"))


def ancestors(edges: DataFrame, child: str = "child", parent: str = "parent", most: int = 50) -> DataFrame:
    """``child, ancestor, steps``: all ancestors in a directed acyclic graph with the least number of steps.

    One join per level; the new pairs are written each time, so the plan stays small. More than ``most`` levels is an error.
    """
    step = materialize(edges.select(F.col(child).alias("child"), F.col(parent).alias("ancestor")).dropna().distinct(), "edges")
    found, level = step.withColumn("steps", F.lit(1)), 1
    new = step
    while True:
        level += 1
        if level > most:
            raise ValueError(f"more than {most} levels")
        new = new.join(step.select(F.col("child").alias("ancestor"), F.col("ancestor").alias("next")), "ancestor").select("child", F.col("next").alias("ancestor")).distinct()
        new = materialize(new.join(found, ["child", "ancestor"], "left_anti"), "level")
        if new.isEmpty():
            return found
        found = found.unionByName(new.withColumn("steps", F.lit(level)))


# ---------------------------------------------------------------- scores


def set_activity(x: DataFrame, sets: DataFrame, set_id: str, cell: str, gene: str, value: str) -> DataFrame:
    """Sum of the members' values per set and cell."""
    return x.join(sized_broadcast(sets.select(set_id, gene).distinct()), gene).groupBy(set_id, cell).agg(F.sum(value).alias("activity"))


def module_score(x: DataFrame, features: DataFrame, cell: str, gene: str, value: str, n_cells: int, bins: int = 24, controls: int = 100, seed: int = 1) -> DataFrame:
    """Per cell: mean of the features less the mean of control genes of about the same mean expression.

    Genes are cut into equally many-membered bins of their mean; each feature brings the ``controls`` genes of its bin with the least
    hashes, and a gene counts once. Absent entries are zeros: means divide by the number of genes.
    """
    means = x.groupBy(gene).agg((F.sum(value) / n_cells).alias("m"))
    binned = materialize(means.withColumn("bin", F.ntile(bins).over(Window.orderBy("m", gene))), "gene-bins")
    f = materialize(binned.join(features.select(gene).distinct(), gene, "left_semi"), "features")
    drawn = binned.withColumn("k", F.row_number().over(Window.partitionBy("bin").orderBy(F.xxhash64(gene, F.lit(seed)), gene))).filter(F.col("k") <= controls)
    c = materialize(drawn.join(f.select("bin").distinct(), "bin", "left_semi").select(gene), "controls")
    nf, nc = f.count(), c.count()
    roles = f.select(gene, F.lit(1).alias("f"), F.lit(0).alias("c")).unionByName(c.select(gene, F.lit(0).alias("f"), F.lit(1).alias("c"))).groupBy(gene).agg(F.max("f").alias("f"), F.max("c").alias("c"))
    s = x.join(sized_broadcast(roles), gene, "left").groupBy(cell).agg(F.sum(F.coalesce(F.col(value) * F.col("f"), F.lit(0))).alias("sf"), F.sum(F.coalesce(F.col(value) * F.col("c"), F.lit(0))).alias("sc"))
    return s.select(cell, (F.col("sf") / max(nf, 1) - F.col("sc") / max(nc, 1)).alias("score"))


# ---------------------------------------------------------------- correlation and resampling


def correlations(x: DataFrame, gene: str, cell: str, value: str, vector: DataFrame, v: str, n_cells: int) -> DataFrame:
    """Correlation of every gene with one value per cell, absent entries as zeros, from sums over the present ones."""
    sv, qv = vector.agg(F.sum(v).cast("double"), F.sum(F.col(v).cast("double") ** 2)).first()
    s = x.join(vector.select(cell, F.col(v).cast("double").alias("__v")), cell).groupBy(gene).agg(F.sum(F.col(value) * F.col("__v")).alias("xy"), F.sum(value).cast("double").alias("sx"), F.sum(F.col(value).cast("double") ** 2).alias("qx"))
    cov = n_cells * F.col("xy") - F.col("sx") * F.lit(sv)
    sd = F.sqrt((n_cells * F.col("qx") - F.col("sx") ** 2) * F.lit(n_cells * qv - sv * sv))
    return s.select(gene, F.try_divide(cov, F.nullif(sd, F.lit(0.0))).alias("r"))


def sample_correlations(x: DataFrame, sample: str, item: str, value: str, method: str = "pearson", limit: int = 5_000) -> DataFrame:
    """``sample_a <= sample_b, r`` over the items that both have. More than ``limit`` samples are an error.

    ``spearman`` correlates the mean ranks within each sample.
    """
    from .matrix import average_ranks

    bounded(x, sample, limit)
    y = x.select(sample, item, F.col(value).cast("double").alias("v"))
    if method == "spearman":
        y = average_ranks(y, [sample], "v", "r").select(sample, item, F.col("r").alias("v"))
    a = y.select(F.col(sample).alias("sample_a"), item, F.col("v").alias("va"))
    b = y.select(F.col(sample).alias("sample_b"), item, F.col("v").alias("vb"))
    return a.join(b, item).filter("sample_a <= sample_b").groupBy("sample_a", "sample_b").agg(F.corr("va", "vb").alias("r"))


def kendall(x: list[float], y: list[float]) -> float:
    """Kendall's tau-b: discordant pairs are the inversions of y in order of x, counted by a merge sort; NaN if one is constant."""
    n = len(x)
    pairs = sorted(zip(x, y))
    same = lambda keys: sum(c * (c - 1) // 2 for c in Counter(keys).values())
    tx, ty, both = same(a for a, _ in pairs), same(b for _, b in pairs), same(pairs)
    values, swaps, width = [b for _, b in pairs], 0, 1
    while width < n:
        merged: list[float] = []
        for lo in range(0, n, 2 * width):
            left, right = values[lo : lo + width], values[lo + width : lo + 2 * width]
            i = j = 0
            while i < len(left) and j < len(right):
                if right[j] < left[i]:
                    swaps += len(left) - i
                    merged.append(right[j])
                    j += 1
                else:
                    merged.append(left[i])
                    i += 1
            merged += left[i:] + right[j:]
        values, width = merged, 2 * width
    total = n * (n - 1) // 2
    low = math.sqrt((total - tx) * (total - ty))
    return (total - tx - ty + both - 2 * swaps) / low if low else float("nan")


def bca_limits(drawn: np.ndarray, share: float, total: float) -> tuple[float, float]:
    """The 2.5 and 97.5 % limits of a share, corrected for bias and acceleration.

    The acceleration is that of the jackknife; for a share of ``total`` items it has a closed form. Limits of a share of 0 or 1 are the share.
    """
    if not 0 < share < 1:
        return share, share
    normal = NormalDist()
    below = (np.sum(drawn < share) + np.sum(drawn == share) / 2) / len(drawn)
    z0 = normal.inv_cdf(min(max(below, 0.5 / len(drawn)), 1 - 0.5 / len(drawn)))
    a = (1 - 2 * share) / (6 * math.sqrt(total * share * (1 - share)))
    at = [normal.cdf(z0 + (z0 + z) / (1 - a * (z0 + z))) for z in (normal.inv_cdf(0.025), normal.inv_cdf(0.975))]
    low, high = np.quantile(drawn, at)
    return float(low), float(high)


def bootstrap_shares(counts: DataFrame, group: str, kind: str, n: str, rounds: int = 500, seed: int = 1) -> DataFrame:
    """Per group and kind: share, the 2.5th and 97.5th percentile of resampled shares, and the limits ``bca_low``, ``bca_high``.

    A round draws as many items as the group has, multinomially, from the counts: one row per kind goes to Python, not one per item. Draws
    depend on the seed and the group only. ``counts`` has one row per group and kind; null counts are 0.
    """
    ship(counts.sparkSession)
    kept = counts.select(group, kind, F.coalesce(F.col(n).cast("bigint"), F.lit(0)).alias("n"))
    schema = T.StructType([*[f for f in kept.schema if f.name in (group, kind)], *[T.StructField(c, T.DoubleType()) for c in ("share", "low", "high", "bca_low", "bca_high")]])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(kind, kind="stable")
        k, total = rows["n"].to_numpy(np.int64), int(rows["n"].sum())
        out = rows[[group, kind]].copy()
        if not total:
            return out.assign(share=np.nan, low=np.nan, high=np.nan, bca_low=np.nan, bca_high=np.nan)
        rng = np.random.default_rng([seed, zlib.crc32(repr(rows[group].iloc[0]).encode())])
        drawn = rng.multinomial(total, k / total, size=rounds) / total
        share = k / total
        low, high = np.quantile(drawn, [0.025, 0.975], axis=0)
        bca = [bca_limits(drawn[:, i], float(share[i]), total) for i in range(len(k))]
        return out.assign(share=share, low=low, high=high, bca_low=[b[0] for b in bca], bca_high=[b[1] for b in bca])

    return kept.groupBy(group).applyInPandas(run, schema)


def weighted_ks(df: DataFrame, group: str, value: str, weight: str, a: str, b: str) -> DataFrame:
    """One row: the largest distance of two weighted distribution functions. Rows are folded per value before they are walked along."""
    s = df.filter(F.col(group).isin(a, b)).groupBy(value).agg(F.coalesce(F.sum(F.when(F.col(group) == a, F.col(weight))), F.lit(0)).alias("wa"), F.coalesce(F.sum(F.when(F.col(group) == b, F.col(weight))), F.lit(0)).alias("wb"))
    w, all_of = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    d = F.sum("wa").over(w) / F.sum("wa").over(all_of) - F.sum("wb").over(w) / F.sum("wb").over(all_of)
    return s.select(F.abs(d).alias("d")).agg(F.max("d").alias("ks"))


def summary_with_error(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Mean and standard error per group."""
    return df.groupBy(*group).agg(F.avg(value).alias("mean"), (F.stddev_samp(value) / F.sqrt(F.count(value))).alias("se"))


def within_gates(df: DataFrame, gates: dict[str, tuple[float | None, float | None]]) -> Column:
    """All columns within their limits (exclusive; None is open)."""
    ok = F.lit(True)
    for c, (low, high) in gates.items():
        ok = ok & (F.col(c) > low if low is not None else F.lit(True)) & (F.col(c) < high if high is not None else F.lit(True))
    return ok
