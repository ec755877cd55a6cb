"""Library metrics and molecule counts over a stream of reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windowed_metrics(reads: DataFrame, stamp: str, library: str, flags: dict[str, Column], width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Per window and library: reads and those with each flag. Reads later than ``late`` behind the newest are dropped by the watermark; on a batch frame the watermark has no effect."""
    marked = reads.withColumn(stamp, F.col(stamp).cast("timestamp")).withWatermark(stamp, late).select(stamp, library, *[c.alias(n) for n, c in flags.items()])
    per = marked.groupBy(F.window(stamp, width), library).agg(F.count(F.lit(1)).alias("reads"), *[F.count_if(F.col(n)).alias(n) for n in flags])
    return per.select(F.col("window.start").alias("window_start"), library, "reads", *flags)


def running_molecules(reads: DataFrame, gene: str = "gene", cell: str = "cell", umi: str = "umi") -> DataFrame:
    """Reads of every molecule so far: the batch operator's aggregate, whose state is one number per molecule."""
    from ..operators.molecules import reads_per_molecule

    return reads_per_molecule(reads, gene, cell, umi)


def newest_rows(rows: DataFrame, key: str, stamp: str, late: str = "1 hour") -> DataFrame:
    """The first delivery of each key within the watermark: repeated deliveries are dropped."""
    return rows.withWatermark(stamp, late).dropDuplicatesWithinWatermark([key])
