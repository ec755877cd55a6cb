"""Receptor reads to receptor tables per cell."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .molecules import correct_substitutions
from .windows import best_per_group, most_frequent

# The chains, and the kind of cell that has them.
CHAINS = {"TCR_Alpha": "T", "TCR_Beta": "T", "TCR_Gamma": "T", "TCR_Delta": "T", "BCR_Heavy": "B", "BCR_Kappa": "B", "BCR_Lambda": "B"}


# The names of the chain codes.
CHAIN_NAMES = {"VA": "TCR_Alpha", "VB": "TCR_Beta", "VH": "BCR_Heavy", "VL": "BCR_Lambda", "VK": "BCR_Kappa", "VG": "TCR_Gamma", "VD": "TCR_Delta", "NON": "NON", "N/A": "N/A"}


def normalised_records(records: DataFrame) -> DataFrame:
    """The columns that later steps use of complete records (``shred.record_table``), renamed, with the chain's code as its name.

    A code that isn't known is null.
    """
    names = F.create_map(*[F.lit(x) for pair in CHAIN_NAMES.items() for x in pair])
    kept = records.filter("is_complete")
    return kept.select("record_id", "sequence_id", F.try_element_at(names, F.col("chain_type")).alias("chain"), F.col("cdr3_nt").alias("cdr3_nucleotide"), "productive", "sequence_length", "n_hits")


def valid_reads(reads: DataFrame, v_limit: float = 1e-10, j_limit: float = 1e-10, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Reads with a CDR3 in both forms, a chain, and V and J e-values below the limits. A missing e-value isn't below."""
    ok = F.col("cdr3_nt").isNotNull() & F.col("cdr3_aa").isNotNull() & F.col("chain").isNotNull() & ~F.col("chain").isin("NON", "N/A", *ignore)
    return reads.filter(ok & (F.col("v_e_value") < v_limit) & (F.col("j_e_value") < j_limit))


def correct_identifiers(reads: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``reads`` with ``value`` replaced by its parent within ``keys``: substitution correction on the reads of each value."""
    counts = reads.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("raw_reads"))
    parents = correct_substitutions(counts, keys, value).filter("parent_umi IS NOT NULL").select(*keys, F.col("umi").alias(value), "parent_umi")
    return reads.join(parents, [*keys, value], "left").withColumn(value, F.coalesce("parent_umi", value)).drop("parent_umi")


def correct_reads(reads: DataFrame) -> DataFrame:
    """UMIs corrected within (cell, chain), then CDR3s of one length within (cell, chain)."""
    umis = correct_identifiers(reads, ["cell", "chain"], "umi")
    sized = umis.withColumn("cdr3_size", F.length("cdr3_nt"))
    return correct_identifiers(sized, ["cell", "chain", "cdr3_size"], "cdr3_nt").drop("cdr3_size")


def modal_translation(reads: DataFrame) -> DataFrame:
    """The most frequent amino-acid form of each CDR3, the first in order on ties."""
    return most_frequent(reads, ["cdr3_nt"], "cdr3_aa").select("cdr3_nt", "cdr3_aa")


def umi_table(reads: DataFrame) -> DataFrame:
    """One row per (cell, chain, UMI): its reads and its representative read.

    Representative: of the most frequent CDR3, a productive one first, then the least V e-value.
    """
    key = ["cell", "chain", "umi"]
    counts = reads.groupBy(*key, "cdr3_nt").agg(F.count(F.lit(1)).alias("n"))
    total = reads.groupBy(*key).agg(F.count(F.lit(1)).alias("reads"))
    order = [F.desc("n"), F.desc("productive"), F.asc_nulls_last("v_e_value"), F.asc("cdr3_nt"), F.asc_nulls_last("v_gene"), F.asc_nulls_last("j_gene"), F.asc_nulls_last("cdr3_aa")]
    best = best_per_group(reads.join(counts, [*key, "cdr3_nt"]), key, order)
    return best.select(*key, "v_gene", "j_gene", "cdr3_nt", "cdr3_aa", "productive").join(total, key)


def chain_table(umis: DataFrame) -> DataFrame:
    """One row per (cell, chain): UMIs, reads, and the dominant CDR3 by UMIs, then reads, then its text."""
    key = ["cell", "chain"]
    clones = umis.groupBy(*key, "cdr3_nt").agg(F.count(F.lit(1)).alias("molecules"), F.sum("reads").alias("reads"), F.min(F.struct("v_gene", "j_gene", "cdr3_aa")).alias("x"))
    total = clones.groupBy(*key).agg(F.sum("molecules").alias("molecules"), F.sum("reads").alias("reads"), F.count(F.lit(1)).alias("clones"))
    top = best_per_group(clones, key, [F.desc("molecules"), F.desc("reads"), F.asc("cdr3_nt")])
    return total.join(top.select(*key, F.col("cdr3_nt").alias("dominant"), F.col("x.v_gene").alias("v_gene"), F.col("x.j_gene").alias("j_gene")), key)


def cell_table(chains: DataFrame, names: list[str]) -> DataFrame:
    """One row per cell: molecules, reads and dominant CDR3 of each chain in ``names``, and totals."""
    wide = chains.groupBy("cell").pivot("chain", names).agg(F.sum("molecules").alias("molecules"), F.sum("reads").alias("reads"), F.first("dominant").alias("dominant"))
    wide = wide.fillna(0, [f"{c}_{v}" for c in names for v in ("molecules", "reads")])
    return with_totals(wide, names)


def with_totals(wide: DataFrame, names: list[str]) -> DataFrame:
    add = lambda v: sum((F.col(f"{c}_{v}") for c in names[1:]), F.col(f"{names[0]}_{v}"))
    return wide.withColumn("total_molecules", add("molecules")).withColumn("total_reads", add("reads"))


def cell_type(types: dict[str, str]) -> Column:
    """``T``, ``B`` or ``Unknown``: the kind with more than twice the other's molecules."""
    n = lambda k: sum((F.col(f"{c}_molecules") for c, t in types.items() if t == k), F.lit(0))
    return F.when(2 * n("T") < n("B"), "B").when(2 * n("B") < n("T"), "T").otherwise("Unknown")


def clear_other_types(wide: DataFrame, types: dict[str, str], kind: str = "cell_type") -> DataFrame:
    """Chains that a cell of its type can't have are cleared; cells of other known types lose all; totals are new."""
    of = lambda k: (F.col(kind) == k) | F.startswith(F.col(kind), F.lit(k + "_"))
    out = wide
    for c, t in types.items():
        keep = of(t) | (F.col(kind) == "Unknown")
        out = out.withColumns({f"{c}_{v}": F.when(keep, F.col(f"{c}_{v}")).otherwise(F.lit(0)) for v in ("molecules", "reads")} | {f"{c}_dominant": F.when(keep, F.col(f"{c}_dominant"))})
    return with_totals(out, list(types))


def below_cutoff_cleared(wide: DataFrame, cutoffs: dict[str, float], names: list[str]) -> DataFrame:
    """Chains with fewer reads than their cutoff are cleared; totals are new."""
    out = wide
    for c, limit in cutoffs.items():
        keep = F.col(f"{c}_reads") >= limit
        out = out.withColumns({f"{c}_molecules": F.when(keep, F.col(f"{c}_molecules")).otherwise(F.lit(0)), f"{c}_dominant": F.when(keep, F.col(f"{c}_dominant")), f"{c}_reads": F.when(keep, F.col(f"{c}_reads")).otherwise(F.lit(0))})
    return with_totals(out, names)


def consolidated(wide: DataFrame, light: tuple[str, str], alpha_beta: tuple[str, str], gamma_delta: tuple[str, str]) -> DataFrame:
    """Like chains in one column each: the light chain of more molecules, and one of the two T pairs.

    A pair with both chains comes first, then the pair of more molecules, the first on ties.
    """
    n = lambda c: F.col(f"{c}_molecules")
    (a, b), (g, d), (k, m) = alpha_beta, gamma_delta, light
    both_ab, both_gd = (n(a) > 0) & (n(b) > 0), (n(g) > 0) & (n(d) > 0)
    first = F.when(both_ab & ~both_gd, True).when(both_gd & ~both_ab, False).otherwise(n(a) + n(b) >= n(g) + n(d))
    pick = lambda cond, x, y, name: [F.when(cond, F.col(f"{x}_{v}")).otherwise(F.col(f"{y}_{v}")).alias(f"{name}_{v}") for v in ("molecules", "reads", "dominant")]
    return wide.select("cell", *pick(n(k) >= n(m), k, m, "light"), *pick(first, a, g, "first"), *pick(first, b, d, "second"))


def mixture_cutoff(counts: dict[int, float], most: int = 4, rounds: int = 300) -> float | None:
    """Reads at which the peaks of log10 reads per cell below and above the widest gap meet; None if one peak explains them as well.

    Mixtures of one to ``most`` normals, fitted by expectation-maximisation; the number is chosen by Akaike's criterion.
    """
    x = np.log10(np.array([c for c in sorted(counts) if c > 0], dtype=float))
    w = np.array([counts[c] for c in sorted(counts) if c > 0], dtype=float)
    if len(x) < 4:
        return None
    fits = []
    total = w.sum()
    cdf = np.cumsum(w) / total
    for k in range(1, most + 1):
        mean = np.interp((np.arange(k) + 0.5) / k, cdf, x)
        var = np.full(k, max(np.average((x - np.average(x, weights=w)) ** 2, weights=w) / k**2, 1e-3))
        share = np.full(k, 1 / k)
        like = -np.inf
        for _ in range(rounds):
            logs = np.log(share) - 0.5 * np.log(2 * math.pi * var) - (x[:, None] - mean) ** 2 / (2 * var)
            top = logs.max(axis=1, keepdims=True)
            dens = np.exp(logs - top)
            each = dens.sum(axis=1, keepdims=True)
            new = float((w * (top[:, 0] + np.log(each[:, 0]))).sum())
            r = dens / each * w[:, None]
            size = np.maximum(r.sum(axis=0), 1e-9)
            mean = (r * x[:, None]).sum(axis=0) / size
            var = np.maximum((r * (x[:, None] - mean) ** 2).sum(axis=0) / size, 1e-3)
            share = size / size.sum()
            if new - like < 1e-8:
                break
            like = new
        fits.append((2 * (3 * k - 1) - 2 * like, k, mean, var, share))
    _, k, mean, var, share = min(fits, key=lambda f: f[0])
    if k == 1:
        return None
    order = np.argsort(mean)
    mean, var, share = mean[order], var[order], share[order]
    part = int(np.argmax(np.diff(mean))) + 1  # signal and noise lie on either side of the widest gap
    grid = np.linspace(mean[part - 1], mean[part], 200)
    dens = share / np.sqrt(var) * np.exp(-((grid[:, None] - mean) ** 2) / (2 * var))
    reached = np.flatnonzero(dens[:, part:].sum(axis=1) >= dens[:, :part].sum(axis=1))
    return float(10 ** grid[reached[0]]) if len(reached) else None


def read_cutoffs(chains: DataFrame, n_cells: int, least_depth: float = 4.0) -> DataFrame:
    """``chain, cutoff``: chains with more than ``least_depth`` reads per cell, and the reads that part signal from noise (null without two peaks).

    One group of a few rows per chain: the histogram of reads per cell.
    """
    ship(chains.sparkSession)
    deep = chains.groupBy("chain").agg(F.sum("reads").alias("s")).filter(F.col("s") > least_depth * n_cells)
    bars = chains.join(deep, "chain", "left_semi").groupBy("chain", F.col("reads").cast("bigint").alias("v")).agg(F.count(F.lit(1)).alias("n"))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"chain": [g["chain"].iloc[0]], "cutoff": [mixture_cutoff(dict(zip(g["v"], g["n"].astype(float))))]})

    return bars.groupBy("chain").applyInPandas(run, "chain string, cutoff double")
