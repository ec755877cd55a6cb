"""Aggregations: one-pass conditional counts, combined levels, signal against noise, summaries of groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent(part: Column | str, whole: Column | str) -> Column:
    """100 part / whole; null where the whole is 0."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.try_divide(100.0 * c(part), c(whole))


def with_total(df: DataFrame, key: str, aggregates: list[Column], label: str = "All") -> DataFrame:
    """Aggregates per key and over all rows, in one pass by grouping sets. A null key stays null."""
    grouped = df.groupingSets([[key], []], key).agg(*aggregates, F.grouping(key).alias("__all"))
    return grouped.withColumn(key, F.when(F.col("__all") == 1, label).otherwise(F.col(key))).drop("__all")


def library_metrics(reads: DataFrame, library: str, flags: dict[str, Column]) -> DataFrame:
    """Per library and together: the number of reads, and of those with each flag, with its percentage."""
    counts = with_total(reads.select(library, *[c.alias(n) for n, c in flags.items()]), library, [F.count(F.lit(1)).alias("reads"), *[F.count_if(F.col(n)).alias(n) for n in flags]])
    return counts.select(library, "reads", *flags, *[percent(n, "reads").alias(f"pct_{n}") for n in flags])


def combine_libraries(metrics: DataFrame, library: str, whole: str, parts: list[str], label: str = "Combined") -> DataFrame:
    """Library metrics and their sum; percentages of the whole are computed anew, null where nothing is known."""
    out = with_total(metrics, library, [F.sum(c).alias(c) for c in (whole, *parts)], label)
    return out.select(library, whole, *parts, *[percent(p, whole).alias(f"pct_{p}") for p in parts])


def weighted_mean(value: Column | str, weight: Column | str) -> Column:
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.try_divide(F.sum(c(value) * c(weight)), F.sum(F.when(c(value).isNotNull(), c(weight))))


def count_and_share(df: DataFrame, key: str, weight: Column | None = None, n: str = "n") -> DataFrame:
    """Count (or sum of ``weight``) per key and its percentage of all. The window runs over one row per key."""
    grouped = df.groupBy(key).agg((F.sum(weight) if weight is not None else F.count(F.lit(1))).alias(n))
    total = F.sum(n).over(Window.partitionBy())
    return grouped.withColumn("pct", percent(n, total))


def molecule_metrics(molecules: DataFrame, kind: str, columns: list[str]) -> DataFrame:
    """Per kind and combined: count, sum, median and mean of each column's values above 0, and its singletons.

    A 0 is a molecule that a correction took away, so it counts as missing.
    """
    some = {c: F.nullif(F.col(c), F.lit(0)) for c in columns}
    aggs = [f.alias(f"{c}_{n}") for c in columns for n, f in (("molecules", F.count(c)), ("reads", F.sum(c)), ("median", F.median(c)), ("mean", F.avg(c)), ("singletons", F.count_if(F.col(c) == 1)))]
    return with_total(molecules.select(kind, *[x.alias(c) for c, x in some.items()]), kind, aggs, "Combined")


def saturation(reads: Column | str, singletons: Column | str) -> Column:
    """100 (1 - singletons / reads)."""
    return 100.0 - percent(singletons, reads)


def cell_metrics(cell_gene: DataFrame, cells: DataFrame, cell: str, kind: str, kinds: list[str], value: str) -> DataFrame:
    """Per kind: least, greatest, mean, median and sum over all called cells, of sum and count of ``value`` per cell.

    A called cell without any row of a kind counts as 0.
    """
    per = cell_gene.join(cells.select(cell), cell, "left_semi").groupBy(cell, kind).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n_genes"))
    domain = cells.select(cell).distinct().withColumn(kind, F.explode(F.array(*[F.lit(k) for k in kinds])))
    full = domain.join(per, [cell, kind], "left").fillna(0, ["total", "n_genes"])
    stats = lambda c: [f(c).alias(f"{n}_{c}") for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("median", F.median), ("sum", F.sum))]
    return full.groupBy(kind).agg(*stats("total"), *stats("n_genes"))


def gene_summary(molecules: DataFrame, gene: str = "gene", raw: str = "raw_reads", rsec: str = "rsec_reads", dbec: str = "dbec_reads", panel: DataFrame | None = None, enough: float = 4.0) -> DataFrame:
    """Per gene: reads, molecules and depths before and after each correction.

    The depth after substitution correction is raw reads per corrected molecule. ``status`` is ``pass`` from ``enough`` reads
    per molecule on, singletons left out, else ``low_depth``; genes of the panel without any molecule are ``not_detected``.
    """
    n = lambda c: F.count(F.when(F.col(c) > 0, 1))
    s = lambda c: F.coalesce(F.sum(F.when(F.col(c) > 0, F.col(c))), F.lit(0))
    g = molecules.groupBy(gene).agg(
        s(raw).alias("raw_reads"),
        n(raw).alias("raw_molecules"),
        n(rsec).alias("rsec_molecules"),
        F.count_if(F.col(rsec) == 1).alias("rsec_singletons"),
        s(rsec).alias("rsec_reads"),
        s(dbec).alias("dbec_reads"),
        n(dbec).alias("dbec_molecules"),
        F.min(F.when(F.col(dbec) > 0, F.col(dbec))).alias("dbec_min_depth"),
    )
    multi = F.col("rsec_molecules") - F.col("rsec_singletons")
    g = g.withColumns(
        {
            "raw_depth": F.try_divide("raw_reads", "raw_molecules"),
            "rsec_depth": F.try_divide("raw_reads", "rsec_molecules"),
            "rsec_depth_multi": F.try_divide(F.col("rsec_reads") - F.col("rsec_singletons"), multi),
            "dbec_depth": F.try_divide("dbec_reads", "dbec_molecules"),
            "pct_error_reads": percent(F.col("rsec_reads") - F.col("dbec_reads"), "rsec_reads"),
            "error_depth": F.try_divide(F.col("rsec_reads") - F.col("dbec_reads"), F.col("rsec_molecules") - F.col("dbec_molecules")),
        }
    )
    g = g.withColumn("status", F.when(F.col("rsec_depth_multi") >= enough, "pass").otherwise("low_depth"))
    if panel is not None:
        g = panel.select(gene).join(g, gene, "left").withColumn("status", F.coalesce("status", F.lit("not_detected")))
    return g


def cells_by_reads(cell_gene: DataFrame, cell: str = "cell", reads: str = "dbec_reads", least: int = 0) -> DataFrame:
    """Total reads per cell, most first."""
    total = cell_gene.groupBy(cell).agg(F.sum(reads).alias("total_reads"))
    return total.filter(F.col("total_reads") >= least).orderBy(F.desc("total_reads"), cell)


def signal_to_noise(counts: DataFrame, cells: DataFrame, cell: str, item: str, value: str, label: str = "All") -> DataFrame:
    """Per item and over all: mean and median within called cells (signal) and outside (noise), their ratios, and the share of reads in cells."""
    marked = counts.join(cells.select(cell).distinct().withColumn("__in", F.lit(True)), cell, "left")
    inside, outside = F.when(F.col("__in"), F.col(value)), F.when(F.col("__in").isNull(), F.col(value))
    aggs = [F.avg(inside).alias("mean_signal"), F.avg(outside).alias("mean_noise"), F.median(inside).alias("median_signal"), F.median(outside).alias("median_noise"), percent(F.sum(inside), F.sum(value)).alias("pct_in_cells")]
    return with_total(marked, item, aggs, label).withColumn("mean_snr", F.try_divide("mean_signal", "mean_noise")).withColumn("median_snr", F.try_divide("median_signal", "median_noise"))


def unique_text(col: str, delimiter: str = "|", empty: str = "-") -> Column:
    """Distinct non-blank values in order, joined; ``-`` if there are none."""
    joined = F.array_join(F.sort_array(F.collect_set(F.when(F.trim(col) != "", F.col(col)))), delimiter)
    return F.when(joined == "", empty).otherwise(joined)


def pseudobulk(expression: DataFrame, group: list[str], gene: str, value: str, library: list[str] | None = None) -> DataFrame:
    """Per group and gene: sum, mean over the group's cells, and counts per million of the library's total."""
    library = library or group
    total = F.sum("total").over(Window.partitionBy(*library))
    return expression.groupBy(*group, gene).agg(F.sum(value).alias("total"), F.avg(value).alias("mean")).withColumn("cpm", F.try_divide(F.col("total") * 1e6, total))


def sparse_means(expression: DataFrame, key: str, value: str, domain_size: int) -> DataFrame:
    """Sum and mean over a domain in which absent entries are zeros: divided by the domain's size, not by the entries."""
    return expression.groupBy(key).agg(F.sum(value).alias("total")).withColumn("mean", F.col("total") / F.lit(domain_size))
