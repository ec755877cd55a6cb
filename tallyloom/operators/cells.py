"""Telling cells from noise by the curve of their reads."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship
from . import windows as wi

# Parameters of the curve and of the refinement.
STEP, MASKED, MOST_WINDOW = 0.1, 20, 500
RANGE = (25, 60_000)
DEPTH = -0.3
Z_CUTOFFS = {"Targeted": (0.53, 0.85, 1.3), "WTA": (1.3, 1.7)}


# ---------------------------------------------------------------- the curve, on sorted totals


def curvature(cumulative: np.ndarray, step: float = STEP, masked: int = MASKED) -> np.ndarray:
    """Second derivative of the log-log cumulative curve, over the first half of the places; else NaN."""
    n = len(cumulative)
    out = np.full(n, np.nan)
    if n < 4:
        return out
    y = np.log10(cumulative[1:].astype(float))
    x = np.log10(np.arange(1, n, dtype=float))
    at = x[1 : n // 2 - 1] if n // 2 > 2 else x[:0]
    left, mid, right = (np.interp(at + d, x, y) for d in (-step, 0.0, step))
    out[2 : 2 + len(at)] = (right - 2 * mid + left) / step**2
    out[:masked] = np.nan
    return out


def smoothed(values: np.ndarray, window: int) -> np.ndarray:
    """Running mean (a local line's middle value); NaN where the window isn't wholly known."""
    out = np.full(len(values), np.nan)
    known = np.flatnonzero(~np.isnan(values))
    if len(known) < window:
        return out
    a, b = known[0], known[-1] + 1
    total = np.concatenate([[0.0], np.cumsum(values[a:b])])
    half = window // 2
    out[a + half : b - half] = (total[window:] - total[:-window]) / window
    return out


def minima(values: np.ndarray) -> list[int]:
    """Cell numbers at the curve's deep minima; smoothed ever wider until at most two are left, deepest first."""
    if np.all(np.isnan(values[50 : RANGE[1]])):
        return []
    cutoff = min(np.nanmin(values[50 : RANGE[1]]) * 0.5, DEPTH)
    window, curve = 3, values
    while True:
        with np.errstate(invalid="ignore"):
            low = np.flatnonzero((curve[1:-1] < curve[:-2]) & (curve[1:-1] < curve[2:])) + 1
        found = [int(m) + 1 for m in low if RANGE[0] <= m <= RANGE[1] and values[m] < cutoff]
        if len(found) <= 2 or window >= MOST_WINDOW:
            return sorted(found, key=lambda m: curve[m] if m < len(curve) else np.inf)
        curve = smoothed(values, window)
        window += 2


def inferred_cells(totals: np.ndarray, expected: int | None = None) -> int:
    """Number of cells told by totals in falling order. No clear minimum, or too few totals, tell 0.

    Of several minima the one nearest to the expected number counts, or else the greatest.
    """
    curve = np.cumsum(totals[totals > 1])
    if len(curve) <= 50:
        return 0
    found = minima(curvature(curve))
    if not found:
        return 0
    if len(found) == 1:
        return found[0]
    return max(found) if expected is None else min(found, key=lambda m: abs(m - expected))


# ---------------------------------------------------------------- on tables


MOST_LABELS = 2_000_000


def count_cells(totals: DataFrame, value: str, expected: int | None = None, limit: int = MOST_LABELS) -> int:
    """``inferred_cells`` of a table of totals per cell label.

    Only the histogram of totals goes to Python: one row per distinct total. There the curve has one number for each label, of which the
    label scheme has 884,736; more than ``limit`` are an error.
    """
    ship(totals.sparkSession)
    if totals.filter(F.col(value) > 1).limit(limit + 1).count() > limit:
        raise ValueError(f"more than {limit} labels")
    bars = totals.filter(F.col(value) > 1).groupBy(F.col(value).cast("bigint").alias("v")).agg(F.count(F.lit(1)).alias("n"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values("v", ascending=False)
        return pd.DataFrame({"cells": [inferred_cells(np.repeat(g["v"].to_numpy(), g["n"].to_numpy()), expected)]})

    found = bars.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(run, "cells int").first()
    return found[0] if found else 0


def top_cells(totals: DataFrame, cell: str, value: str, n: int) -> DataFrame:
    """The ``n`` cells of most reads, ties by the cell."""
    return totals.orderBy(F.desc(value), cell).limit(n).select(cell)


def _called(cell_gene: DataFrame, genes: DataFrame | None, expected: int | None) -> DataFrame | None:
    x = cell_gene if genes is None else cell_gene.join(genes, "gene", "left_semi")
    totals = x.groupBy("cell").agg(F.sum("dbec_reads").alias("total"))
    n = count_cells(totals, "total", expected)
    return top_cells(totals, "cell", "total", n) if n else None


def call_cells(cell_gene: DataFrame, panel_size: int, assay: str = "Targeted", expected: int | None = None, refine: bool = True) -> DataFrame:
    """``cell, algorithm``: the cells of a (cell, gene, dbec_reads, dbec_mols) table.

    ``Basic`` cells are the top of the read curve, less those that no curve over variable genes (one for each z
    cutoff) confirms. ``Refined`` ones come from the curve over genes that the first cells hardly have. Cells with few
    molecules are dropped last: below the largest drop in the last quarter, or below 20 if that would take too many.
    Nothing told by the curve gives an empty table.
    """
    x = materialize(cell_gene.select("cell", "gene", "dbec_reads", "dbec_mols"), "cell-gene")
    empty = x.select("cell", F.lit("Basic").alias("algorithm")).limit(0)
    basic = _called(x, None, expected)
    if basic is None:
        return empty
    basic = materialize(basic, "basic")
    if not refine:
        return basic.withColumn("algorithm", F.lit("Basic"))
    totals = x.groupBy("cell").agg(F.sum("dbec_reads").alias("total")).filter("total > 1")
    z = x.join(totals.select("cell"), "cell", "left_semi")
    stats = materialize(wi.dispersion(z, "gene", "dbec_reads", max(2, totals.count())), "dispersion")
    noise = basic
    for cutoff in Z_CUTOFFS[assay]:
        confirmed = _called(z, wi.variable_genes(stats, cutoff=cutoff).select("gene"), expected)
        noise = noise.join(confirmed, "cell", "left_anti") if confirmed is not None else noise.limit(0)
    kept = materialize(basic.join(noise, "cell", "left_anti"), "kept")
    per_gene = z.join(kept.withColumn("in", F.lit(True)), "cell", "left").groupBy("gene").agg(F.sum("dbec_reads").alias("a"), F.coalesce(F.sum(F.when(F.col("in"), F.col("dbec_reads"))), F.lit(0)).alias("k"))
    per_gene = materialize(per_gene, "gene-reads")
    if assay == "WTA":
        least = wi.count_threshold(per_gene, "a").first()[0]
        per_gene = per_gene.filter(F.col("a") > least)
    missed = wi.under_represented(per_gene, "gene", "a", "k", panel_size, 0.5 if assay == "WTA" else 1).select("gene")
    found = _called(z, materialize(missed, "missed"), expected)
    added = found.join(kept, "cell", "left_anti") if found is not None else kept.limit(0)
    both = kept.withColumn("algorithm", F.lit("Basic")).unionByName(added.withColumn("algorithm", F.lit("Refined")))
    mols = materialize(both.join(z.groupBy("cell").agg(F.sum("dbec_mols").alias("mols")), "cell"), "called")
    drop = wi.largest_drop(mols, "mols", "cell").first()
    cutoff, jump = drop["cutoff"], drop["jump"]
    if cutoff is None:
        return mols.select("cell", "algorithm")
    share = mols.agg(F.avg(F.when(F.col("mols") < cutoff, 1.0).otherwise(0.0))).first()[0] or 0.0
    if share > 0.2 and jump < 500 or jump == 1:
        cutoff = 20
    return mols.filter(F.col("mols") >= cutoff).select("cell", "algorithm")


def label_statistics(totals: DataFrame, cells: DataFrame, cell: str, value: str) -> DataFrame:
    """One row per class (cells, noise): number, mean and median of reads, and the share of all reads."""
    marked = totals.join(cells.select(cell).withColumn("__in", F.lit(True)), cell, "left")
    kind = F.when(F.col("__in"), "cell").otherwise("noise")
    from pyspark.sql import Window

    s = marked.groupBy(kind.alias("class")).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("reads"), F.avg(value).alias("mean"), F.median(value).alias("median"))
    return s.withColumn("pct_reads", F.try_divide(100.0 * F.col("reads"), F.sum("reads").over(Window.partitionBy())))
