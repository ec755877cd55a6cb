"""Smaller roll-ups and lookups of the read, molecule and cell tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .running import join_groups, numbered

# ---------------------------------------------------------------- reads


def status_of_reads(hits: DataFrame, read: str, gene: str) -> DataFrame:
    """``read, status`` from all alignments of each read: ``no_feature``, ``1`` (one alignment), ``MAcorrected`` (several in one gene), else
    ``alignment_not_unique``. A null gene is none."""
    g = hits.groupBy(read).agg(F.count(F.lit(1)).alias("nh"), F.count_distinct(gene).alias("n_genes"))
    status = F.when(F.col("n_genes") == 0, "no_feature").when(F.col("nh") == 1, "1").when(F.col("n_genes") == 1, "MAcorrected").otherwise("alignment_not_unique")
    return g.select(read, status.alias("status"))


def transcript_summary(reads: DataFrame, by: list[str], transcript: str, size: Column, longest: float = 1000) -> DataFrame:
    """Per read or place: its transcripts, joined, and their mean fragment length, of those below ``longest`` if there are any."""
    names = F.array_join(F.sort_array(F.collect_set(transcript)), "|")
    return reads.groupBy(*by).agg(names.alias("transcripts"), F.coalesce(F.avg(F.when(size < longest, size)), F.avg(size)).alias("mean_fragment"))


def primary_alignments(reads: DataFrame, alignments: DataFrame, read: str, primary: Column, columns: list[str]) -> DataFrame:
    """Every read with the columns of its primary alignment, null where it has none."""
    return reads.select(read).join(alignments.filter(primary).select(read, *columns), read, "left")


# ---------------------------------------------------------------- molecules


def without_correction(molecules: DataFrame, bypass: Column, raw: str = "raw_reads", corrected: str = "rsec_reads", parent: str = "corrected_umi") -> dict[str, Column]:
    """``rsec_reads`` and ``parent_umi``: where ``bypass`` holds, the raw reads and no parent."""
    return {"rsec_reads": F.when(bypass, F.col(raw)).otherwise(F.col(corrected)), "parent_umi": F.when(~bypass, F.col(parent))}


def velocity_input(molecules: DataFrame, cell: str = "cell", umi: str = "umi", corrected: str = "corrected_umi", reads: str = "rsec_reads", least: int = 8) -> DataFrame:
    """Molecules with reads, their cell as ``CB`` and their corrected identifier, if they have one, as ``UB``."""
    ub = F.coalesce(F.when(F.length(corrected) >= least, F.col(corrected)), F.col(umi))
    return molecules.filter(F.col(reads) > 0).withColumns({"CB": F.col(cell), "UB": ub})


# ---------------------------------------------------------------- cells and genes


def cell_quality(expression: DataFrame, cell: str, value: str) -> DataFrame:
    """Per cell the sum of ``value`` and the number of genes that have any."""
    return expression.filter(F.col(value) > 0).groupBy(cell).agg(F.sum(value).alias("n_count"), F.count(F.lit(1)).alias("n_features"))


def percent_above(df: DataFrame, by: list[str], value: str, limit: float, out: str) -> DataFrame:
    """Per group the percentage of rows with ``value`` above the limit."""
    return df.groupBy(*by).agg((100.0 * F.count_if(F.col(value) > limit) / F.count(F.lit(1))).alias(out))


def shares_within(counts: DataFrame, group: str, n: str, out: str = "share") -> DataFrame:
    """Counts, one row per group and kind, with their share of the group's sum."""
    total = counts.groupBy(group).agg(F.sum(n).alias("__all"))
    return join_groups(counts, total, [group]).withColumn(out, (F.col(n) / F.col("__all")).cast("double")).drop("__all")


def lists_by(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """Per group the sorted list of its values. For groups whose lists are short by nature."""
    return df.groupBy(*group).agg(F.sort_array(F.collect_list(value)).alias(out))


def ordered_series(df: DataFrame, group: str, at: str, tie: str, pattern: str = "yyyy-MM-dd") -> DataFrame:
    """Per group: number of rows, the last time, and all times in order, joined. For groups whose series are short by nature."""
    times = F.transform(F.array_sort(F.collect_list(F.struct(at, tie))), lambda x: F.date_format(x[at], pattern))
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.max(at).alias("last"), F.array_join(times, ";").alias("dates"))


def sparse_rows(expression: DataFrame, cell: str, gene: str, value: str, out: str = "counts") -> DataFrame:
    """One text per cell with its genes above 0 as ``{gene=value, ...}``, in order of the gene; a cell has at most as many entries as there are genes."""
    entries = F.array_sort(F.collect_list(F.struct(gene, value)))
    text = F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e[gene], e[value])), ", "), F.lit("}"))
    return expression.filter(F.col(value) > 0).groupBy(cell).agg(text.alias(out))


def gene_order(genes: DataFrame, gene: str, first: Column, out: str = "place") -> DataFrame:
    """Distinct genes numbered from 1, those of ``first`` before all others, each in order of the name."""
    marked = genes.select(gene).distinct().withColumn("is_first", first)
    return numbered(marked, [], [F.desc("is_first"), F.asc(gene)], out).withColumn(out, F.col(out).cast("int"))


def range_sorted(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` sorted as a whole: by ranges, each sorted in its task, so that its files in turn are one sorted table."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def stacked_metrics(wide: DataFrame, sample: str, metrics: list[str]) -> DataFrame:
    """``sample, metric, value`` from a table with a column for each metric."""
    return wide.unpivot([sample], metrics, "metric", "value")


def heatmap_input(means: DataFrame, cluster: str, gene: str, value: str, limit: float = 1.0) -> DataFrame:
    """``lfc``, the log2 ratio to the gene's mean over clusters (of value + 1), and whether it lies beyond the limit.

    ``means`` has one row per cluster and gene.
    """
    lfc = F.log2((F.col(value) + 1) / (F.avg(value).over(Window.partitionBy(gene)) + 1))
    return means.withColumn("lfc", lfc).withColumn("is_outlier", F.abs("lfc") > limit)


def counts_and_part(df: DataFrame, by: str, part: Column, part_name: str) -> DataFrame:
    """Per section its rows and those of a part of them; sections without any of the part are left out."""
    counted = materialize(df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.count_if(part).alias(part_name)), "sections")
    return counted.filter(F.col(part_name) > 0)
