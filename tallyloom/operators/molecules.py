"""Counting molecules and correcting their identifiers."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import materialize, ship

BEAD, PROTEIN_FIRST, COMBINED = "bead", "protein_first", "combined"
NOISE_UMI = "NNNNNNN"
BARCODES = 65_536


def chosen_umi(umi: Column, protein_umi: Column, option: str = BEAD) -> Column:
    """The bead's UMI, the protein's where there is one, or both together."""
    if option == PROTEIN_FIRST:
        return F.coalesce(F.nullif(protein_umi, F.lit("")), umi)
    if option == COMBINED:
        return F.concat(umi, F.coalesce(protein_umi, F.lit("")))
    return umi


def reads_per_molecule(reads: DataFrame, gene: str = "gene", cell: str = "cell", umi: str = "umi") -> DataFrame:
    """Reads of every (gene, cell, UMI); unassigned reads (gene ``*`` or null) don't count."""
    known = reads.filter((F.col(gene) != "*") & F.col(cell).isNotNull() & F.col(umi).isNotNull())
    return known.groupBy(gene, cell, umi).agg(F.count(F.lit(1)).alias("raw_reads"))


def cell_gene_counts(molecules: DataFrame, cell: str = "cell", gene: str = "gene") -> DataFrame:
    """Molecules rolled up to (cell, gene): reads, and numbers of molecules before and after each correction."""
    positive = lambda c: F.count(F.when(F.col(c) > 0, 1))
    total = lambda c: F.coalesce(F.sum(F.when(F.col(c) > 0, F.col(c))), F.lit(0))
    return molecules.groupBy(cell, gene).agg(total("raw_reads").alias("reads"), total("dbec_reads").alias("dbec_reads"), positive("raw_reads").alias("raw_mols"), positive("rsec_reads").alias("rsec_mols"), positive("dbec_reads").alias("dbec_mols"))


def split_by_kind(cell_gene: DataFrame, gene: str = "gene") -> dict[str, DataFrame]:
    """All rows, those of mRNA and those of proteins, by the end of the gene's name."""
    protein = F.endswith(F.col(gene), F.lit("pAbO"))
    return {"all": cell_gene, "mrna": cell_gene.filter(~protein), "protein": cell_gene.filter(protein)}


# ---------------------------------------------------------------- neighbours of identifiers

LETTERS = "ACGTN"


def neighbour_pairs(umis: DataFrame, keys: list[str], umi: str = "umi") -> DataFrame:
    """Pairs ``umi_a < umi_b`` within ``keys`` that differ in at most one place, by equi-joins only.

    Of two equally long texts that differ in one place, one half is equal. So each is filed under both of its
    halves, and only those that share a half, and the length, meet. No group is compared all against all.
    """
    u = F.col("umi")
    half = F.ceil(F.length(u) / 2).cast("int")
    halves = F.array(F.struct(F.lit(1).alias("no"), F.substr(u, F.lit(1), half).alias("text")), F.struct(F.lit(2).alias("no"), F.substr(u, half + 1, F.lit(1 << 20)).alias("text")))
    once = umis.select(*keys, F.col(umi).alias("umi")).distinct()
    filed = once.select(*keys, "umi", F.length(u).alias("size"), F.explode(halves).alias("h")).select(*keys, "umi", "size", F.col("h.no").alias("no"), F.col("h.text").alias("text"))
    a = filed.withColumnRenamed("umi", "umi_a")
    b = filed.withColumnRenamed("umi", "umi_b")
    # Of equally long texts, an edit distance of 1 is one substitution; exactly one half differs then, so a pair meets once.
    near = a.join(b, [*keys, "size", "no", "text"]).filter((F.col("umi_a") < F.col("umi_b")) & (F.levenshtein("umi_a", "umi_b", 1) == 1))
    return near.select(*keys, "umi_a", "umi_b")


def cluster_umis(counts: dict[str, int], ratio: float = 2.0) -> dict[str, str]:
    """Identifier -> the parent it belongs to, in one group.

    There is an edge from a to b if they differ in at most one place and a has at least ``ratio`` times b's
    reads. By falling count (then by text) every identifier not yet taken takes all that it reaches through
    identifiers not yet taken. Neighbours are found through the letters that can stand in each place, so the
    work grows with the identifiers times their length.
    """
    order = sorted(counts, key=lambda u: (-counts[u], u))
    parent: dict[str, str] = {}
    for u in order:
        if u in parent:
            continue
        parent[u] = u
        todo = [u]
        while todo:
            x = todo.pop()
            for i, c in enumerate(x):
                for letter in LETTERS:
                    if letter != c:
                        y = x[:i] + letter + x[i + 1 :]
                        if y not in parent and y in counts and counts[x] >= ratio * counts[y]:
                            parent[y] = u
                            todo.append(y)
    return parent


def correct_substitutions(molecules: DataFrame, keys: list[str], umi: str = "umi", reads: str = "raw_reads", ratio: float = 2.0) -> DataFrame:
    """Recursive substitution correction: ``keys, umi, raw_reads, rsec_reads, parent_umi``.

    Within each group of ``keys`` an identifier's reads go to its parent (``cluster_umis``); a parent's
    ``parent_umi`` is null. The sum of reads of a group stays. Reads of equal identifiers are summed first.
    Only identifiers with a neighbour go to Python: the others, the bulk, stay in the engine. A group in
    Python holds at most 4 to the power of the identifier's length rows (65,536 for 8 letters), however many
    reads it has. Rows with nulls are dropped.
    """
    ship(molecules.sparkSession)
    clean = molecules.select(*keys, F.col(umi).alias("umi"), F.col(reads).cast("bigint").alias("raw_reads")).dropna().groupBy(*keys, "umi").agg(F.sum("raw_reads").alias("raw_reads"))
    clean = materialize(clean, "molecule-reads")
    pairs = neighbour_pairs(clean, keys, "umi")
    touched = pairs.select(*keys, F.explode(F.array("umi_a", "umi_b")).alias("umi")).distinct()
    marked = materialize(clean.join(touched.withColumn("__near", F.lit(True)), [*keys, "umi"], "left"), "near-molecules")
    alone = marked.filter("__near IS NULL").select(*keys, "umi", "raw_reads", F.col("raw_reads").alias("rsec_reads"), F.lit(None).cast("string").alias("parent_umi"))
    near = marked.filter("__near").drop("__near")
    schema = T.StructType([*[f for f in clean.schema if f.name in keys], T.StructField("umi", T.StringType()), T.StructField("raw_reads", T.LongType()), T.StructField("rsec_reads", T.LongType()), T.StructField("parent_umi", T.StringType())])

    def finish(key: tuple, counts: dict[str, int]) -> Iterator[tuple]:
        parent = cluster_umis(counts, ratio)
        total: dict[str, int] = defaultdict(int)
        for u, p in parent.items():
            total[p] += counts[u]
        for u, p in parent.items():
            yield (*key, u, counts[u], total[u] if p == u else 0, None if p == u else p)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, counts = None, {}
        for b in batches:
            for *key, u, n in zip(*(c.to_pylist() for c in b.columns)):
                if key != at:
                    if counts:
                        yield from finish(tuple(at), counts)
                    at, counts = key, {}
                counts[u] = n
        if counts:
            yield from finish(tuple(at), counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = groups(batches)
        while chunk := [*islice(rows, 20_000)]:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*chunk), kinds)], names=schema.names)

    # Groups lie next to each other in a sorted partition, so that one task streams through many small ones.
    kinds = [f.type for f in to_arrow_schema(schema)]
    laid = near.select(*keys, "umi", "raw_reads").repartition(*keys).sortWithinPartitions(*keys)
    return alone.unionByName(laid.mapInArrow(run, schema))


# ---------------------------------------------------------------- depth of molecules per gene


def depth_branches(molecules: DataFrame, gene: str = "gene", reads: str = "rsec_reads", low_depth: float = 4.0, freq: str | None = None) -> DataFrame:
    """Per gene, what decides how it is corrected: counts, sums, depths and the branch.

    ``low_depth``: no molecule with more than one read, or their mean below the limit; ``no_singletons``:
    nothing to separate; else ``fit``. Molecules without reads don't count. With ``freq`` a row stands for so many molecules.
    """
    n = F.col(reads)
    f = F.col(freq) if freq else F.lit(1)
    some = lambda cond: F.coalesce(F.sum(F.when(cond, f)), F.lit(0)).cast("bigint")
    stats = molecules.filter(n > 0).groupBy(gene).agg(some(n > 0).alias("molecules"), F.sum(n * f).cast("bigint").alias("reads"), some(n == 1).alias("singletons"), some(n > 1).alias("multi_molecules"), F.sum(F.when(n > 1, n * f)).cast("bigint").alias("multi_reads"), F.count_distinct(n).alias("distinct_counts"))
    branch = F.when((F.col("multi_molecules") == 0) | (F.col("multi_reads") < low_depth * F.col("multi_molecules")), "low_depth").when(F.col("singletons") == 0, "no_singletons").otherwise("fit")
    return stats.withColumn("branch", branch)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers, by Stirling's series after a shift beyond 10."""
    x = np.asarray(x, dtype=float)
    shift = np.zeros_like(x)
    for _ in range(10):
        low = x < 10
        if not low.any():
            break
        shift[low] -= np.log(x[low])
        x = np.where(low, x + 1, x)
    inverse = 1 / (x * x)
    series = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse / 1680))) / x
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series


def _log_nb(k: np.ndarray, constant: np.ndarray, size: float, mu: np.ndarray | float) -> np.ndarray:
    return constant + size * np.log(size / (size + mu)) + k * np.log(mu / (size + mu))


def separation_cutoffs(fitted: list[dict[int, float]], observed: list[list[int]], size: float = 10.0, rounds: int = 200) -> list[int | None]:
    """Per gene the least number of reads at which the signal is as likely as the noise, or None without two peaks.

    Two negative binomials of one given size are fitted by expectation-maximisation to a histogram of reads
    per molecule, those of all genes together; the noise's mean stays at 1. The cutoff is the first of the ``observed`` counts,
    other than the least, that is as likely under the signal; if the one before it lies above half of the greatest, the cutoff is 2.
    """
    out: list[int | None] = [None] * len(fitted)
    at = [g for g, c in enumerate(fitted) if len(c) >= 3]
    if not at:
        return out
    sorted_counts = [sorted(fitted[g]) for g in at]
    lengths = np.array([len(c) for c in sorted_counts])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    gene = np.repeat(np.arange(len(at)), lengths)
    k = np.concatenate([np.array(c, dtype=float) for c in sorted_counts])
    w = np.array([fitted[g][x] for g, c in zip(at, sorted_counts) for x in c], dtype=float)
    constant = _log_gamma(k + size) - math.lgamma(size) - _log_gamma(k + 1.0)
    noise = _log_nb(k, constant, size, 1.0)
    mu = np.array([max(c[-3], 2.0) for c in sorted_counts], dtype=float)
    share = np.full(len(at), 0.5)
    whole = np.add.reduceat(w, starts)
    failed = np.zeros(len(at), dtype=bool)
    running = np.ones(len(at), dtype=bool)
    for _ in range(rounds):
        odds = np.log(share / (1 - share))[gene] + _log_nb(k, constant, size, mu[gene]) - noise
        r = w / (1 + np.exp(-np.clip(odds, -700, 700)))
        taken = np.add.reduceat(r, starts)
        failed |= running & (taken <= 0)
        running &= ~failed
        new = np.where(running, np.add.reduceat(r * k, starts) / np.maximum(taken, 1e-300), mu)
        share = np.where(running, np.clip(taken / whole, 1e-6, 1 - 1e-6), share)
        running &= np.abs(new - mu) >= 1e-9
        mu = new
        if not running.any():
            break
    for n, g in enumerate(at):
        if failed[n] or mu[n] <= 1.5:
            continue
        x = np.array(sorted(observed[g]), dtype=float)
        more = x * math.log(mu[n] * (size + 1) / (size + mu[n])) + size * math.log((size + 1) / (size + mu[n]))  # signal less noise
        later = np.flatnonzero(more[1:] >= 0) + 1
        if len(later):
            j = int(later[0])
            out[g] = 2 if x[j - 1] > x[-1] / 2 else int(x[j])
    return out


def separation_cutoff(counts: dict[int, float], observed: list[int] | None = None) -> int | None:
    """``separation_cutoffs`` of one gene; the observed counts are by default those that are fitted."""
    return separation_cutoffs([counts], [observed if observed is not None else [*counts]])[0]


def fitted_counts(observed: dict[int, int], doublets: float = 0, enough_counts: int = 10) -> dict[int, float]:
    """The histogram that is fitted: without the ``doublets`` greatest molecules, or, if there are few distinct counts, with one pseudo-molecule
    for every count from 0 that doesn't occur to a hundred for each that does."""
    if len(observed) < enough_counts:
        return {c: observed[c] * 100.0 if c in observed else 1.0 for c in range(max(observed) + 1)}
    counts, left = {c: float(n) for c, n in observed.items()}, doublets
    for c in sorted(counts, reverse=True):
        off = min(left, counts[c])
        counts[c] -= off
        left -= off
        if not left:
            break
    return {c: n for c, n in counts.items() if n > 0}


def doublet_rate(n: int, barcodes: int = BARCODES) -> float:
    """Share of taken barcodes that hold two or more of ``n`` molecules, by Poisson."""
    lam = n / barcodes
    none = math.exp(-lam)
    return (1 - none - lam * none) / (1 - none) if lam > 0 else 0.0


def depth_cutoffs(molecules: DataFrame, gene: str = "gene", cell: str = "cell", reads: str = "rsec_reads", barcodes: int = BARCODES, enough_counts: int = 10, least_cell: int = 400) -> DataFrame:
    """``gene, branch, status, cutoff``: the least reads of a molecule that isn't noise, per gene.

    Branches as in ``depth_branches``; they take cutoff 0. For ``fit`` only the histogram of reads per molecule
    (one row per gene and count) goes to Python. Before it, in cells with more than ``least_cell`` molecules of the gene, the
    counts above the percentile of the doublet rate are taken off the top. Few distinct counts get pseudo-counts.
    A fit that fails removes singletons: cutoff 2, ``separation_failed``. The molecules are read once: what is counted
    per gene, cell and number of reads is written, and all else comes from it.
    """
    ship(molecules.sparkSession)
    bars = molecules.filter(F.col(reads) > 0).groupBy(gene, cell, F.col(reads).cast("bigint").alias("count")).agg(F.count(F.lit(1)).alias("freq"))
    bars = materialize(bars, "depth-bars")
    branches = materialize(depth_branches(bars, gene, "count", freq="freq"), "depth-branches")
    fit = bars.join(branches.filter("branch = 'fit'").select(gene), gene, "left_semi")
    doublets = _doublets(fit, gene, cell, barcodes, least_cell)
    histogram = fit.groupBy(gene, "count").agg(F.sum("freq").alias("freq")).join(doublets, gene, "left").fillna(0, ["doublets"])
    schema = T.StructType([T.StructField(gene, T.StringType()), T.StructField("status", T.StringType()), T.StructField("cutoff", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for genes, observed, doublets in _whole_genes(batches):
            cuts = separation_cutoffs([fitted_counts(o, d, enough_counts) for o, d in zip(observed, doublets)], [[*o] for o in observed])
            yield pa.RecordBatch.from_arrays([pa.array(genes, pa.string()), pa.array(["pass" if c else "separation_failed" for c in cuts], pa.string()), pa.array([c or 2 for c in cuts], pa.int32())], names=schema.names)

    # The genes of a sorted partition are fitted many at a time.
    laid = histogram.select(F.col(gene).cast("string").alias(gene), "count", "freq", F.col("doublets").cast("double").alias("doublets")).repartition(gene).sortWithinPartitions(gene)
    fitted = laid.mapInArrow(run, schema)
    plain = branches.filter("branch != 'fit'").select(gene, "branch", F.when(F.col("branch") == "low_depth", "low_depth").otherwise("pass").alias("status"), F.lit(0).alias("cutoff"))
    return plain.unionByName(fitted.select(gene, F.lit("fit").alias("branch"), "status", "cutoff"))


def _whole_genes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[dict[int, int]], list[float]]]:
    """Genes, observed counts and doublets from sorted rows; a gene that goes on in the next batch waits for its rest."""
    genes, observed, doublets = [], [], []
    for b in batches:
        for g, c, f, d in zip(*(x.to_pylist() for x in b.columns)):
            if not genes or genes[-1] != g:
                genes.append(g)
                observed.append({})
                doublets.append(d)
            observed[-1][c] = f
        if len(genes) > 1:
            yield genes[:-1], observed[:-1], doublets[:-1]
            genes, observed, doublets = genes[-1:], observed[-1:], doublets[-1:]
    if genes:
        yield genes, observed, doublets


def _doublets(bars: DataFrame, gene: str, cell: str, barcodes: int, least_cell: int) -> DataFrame:
    """Molecules above the doublet percentile of their cell, per gene; from (gene, cell, count, freq), no list of a cell's molecules."""
    from pyspark.sql import Window

    per = Window.partitionBy(gene, cell)
    bars = bars.withColumn("n", F.sum("freq").over(per)).filter(F.col("n") > least_cell).withColumn("upto", F.sum("freq").over(per.orderBy("count")))
    lam = F.col("n") / barcodes
    none = F.exp(-lam)
    rate = F.bround((1 - none - lam * none) / (1 - none), 3)
    at = (1 - rate) * (F.col("n") - 1)
    value = lambda p: F.min(F.when(F.col("upto") > p, F.col("count"))).over(per)
    low, high = value(F.floor(at)), value(F.ceil(at))
    depth = low + (high - low) * (at - F.floor(at))
    return bars.withColumn("depth", depth).filter(F.col("count") > F.col("depth")).groupBy(gene).agg(F.sum("freq").alias("doublets"))


def apply_cutoffs(molecules: DataFrame, cutoffs: DataFrame, gene: str = "gene", reads: str = "rsec_reads", parent: str = "parent_umi") -> DataFrame:
    """Add ``dbec_reads`` and ``corrected_umi``: a molecule below its gene's cutoff has 0 and the noise mark."""
    noise = F.col(reads) < F.coalesce(F.col("cutoff"), F.lit(0))
    marked = molecules.join(cutoffs.select(gene, "cutoff"), gene, "left")
    return marked.withColumn("dbec_reads", F.when(noise, F.lit(0)).otherwise(F.col(reads))).withColumn("corrected_umi", F.when(noise & (F.col(reads) > 0), NOISE_UMI).otherwise(F.col(parent))).drop("cutoff")


def corrected_umis(molecules: DataFrame, keys: list[str], umi: str = "umi", corrected: str = "corrected_umi", least: int = 8) -> DataFrame:
    """Identifiers with a corrected form of at least ``least`` letters, which the noise mark hasn't."""
    return molecules.filter(F.length(corrected) >= least).select(*keys, umi, corrected)


def uses_depth_correction(assay: str, gene: Column, forced: bool = False) -> Column:
    """Targeted assays always, whole-transcriptome ones for proteins or when forced; sample tags never."""
    tag = F.endswith(gene, F.lit("stAbO"))
    protein = F.endswith(gene, F.lit("pAbO"))
    return ~tag & (F.lit(assay == "Targeted" or forced) | protein)
