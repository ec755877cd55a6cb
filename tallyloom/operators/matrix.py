"""Expression matrices in long form: normalising, distances, components, clusters and how they agree."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .joins import bounded
from .running import accumulated, join_groups, ranges

#: Items of a group whose distances are held as one matrix of doubles: 288 MB.
MOST_ITEMS = 6_000

# ---------------------------------------------------------------- genes and normalising


def kept_genes(x: DataFrame, gene: str, value: str, above: float, without: str = "MT-", listed: DataFrame | None = None) -> DataFrame:
    """Genes with a total above the limit, none with the given prefix, of the list if one is given."""
    g = x.groupBy(gene).agg(F.sum(value).alias("total")).filter((F.col("total") > above) & ~F.startswith(F.col(gene), F.lit(without)))
    return g if listed is None else g.join(listed, gene, "left_semi")


def normalised(x: DataFrame, cell: str, value: str, to: float | str = "median", log: str | None = None, out: str = "x") -> DataFrame:
    """Values times ``to`` over the cell's total; ``to`` may be ``median``, that of all cells' totals. ``log``: ``e``, ``10`` (of value + 1) or none.

    Totals are one row per cell, joined back; a cell whose total is 0 has nulls.
    """
    totals = x.groupBy(cell).agg(F.sum(value).alias("__total"))
    size = totals.agg(F.median("__total")).first()[0] if to == "median" else to
    y = F.try_divide(F.col(value) * F.lit(float(size or 0)), F.col("__total"))
    y = F.log1p(y) if log == "e" else F.log10(y + 1) if log == "10" else y
    return x.join(totals, cell).withColumn(out, y).drop("__total")


def unit_length(x: DataFrame, row: str, value: str, out: str = "x") -> DataFrame:
    """Rows scaled to length 1; zero rows have nulls."""
    n = x.groupBy(row).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("__n"))
    return x.join(n, row).withColumn(out, F.try_divide(F.col(value), F.col("__n"))).drop("__n")


def average_ranks(df: DataFrame, group: list[str], value: str, out: str = "rank_no") -> DataFrame:
    """Ranks within groups, ties sharing their mean rank; nulls first. What is ranked are the distinct values of a group with their counts."""
    bars = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("__n"))
    order = [F.asc_nulls_first(value)]
    ranked = accumulated(ranges(bars, group, order), group, order, "__upto", "sum", F.col("__n"))
    found = ranked.select(*group, value, (F.col("__upto") - (F.col("__n") - 1) / 2.0).alias(out))
    return join_groups(df.drop(out), found, [*group, value])


# ---------------------------------------------------------------- vectors


def principal_components(vectors: DataFrame, column: str, k: int) -> DataFrame:
    """``vectors`` with ``components``, an array of the first ``k``."""
    v = vectors.withColumn("__v", array_to_vector(F.col(column).cast("array<double>")))
    return PCA(k=k, inputCol="__v", outputCol="__c").fit(v).transform(v).withColumn("components", vector_to_array("__c")).drop("__v", "__c")


def explained_variance(vectors: DataFrame, column: str, k: int) -> list[float]:
    v = vectors.select(array_to_vector(F.col(column).cast("array<double>")).alias("__v"))
    return [float(e) for e in PCA(k=k, inputCol="__v", outputCol="__c").fit(v).explainedVariance]


def without_correlated(components: DataFrame, column: str, k: int, rate: str, limit: float = 0.8) -> list[int]:
    """Numbers (from 0) of the components whose correlation with ``rate`` is at most ``limit`` in size."""
    row = components.agg(*[F.corr(F.col(column)[i], rate).alias(f"c{i}") for i in range(k)]).first()
    return [i for i in range(k) if row[i] is None or abs(row[i]) <= limit]


def k_means(vectors: DataFrame, column: str, k: int, seed: int = 1) -> DataFrame:
    """``vectors`` with ``cluster``."""
    v = vectors.withColumn("__v", array_to_vector(F.col(column).cast("array<double>")))
    return KMeans(k=k, seed=seed, featuresCol="__v", predictionCol="cluster").fit(v).transform(v).drop("__v")


def pair_distances(x: DataFrame, row: str, col: str, value: str, rows: DataFrame | None = None, limit: int = 5_000) -> DataFrame:
    """``row_a < row_b`` with Manhattan, squared Euclidean and correlation distance, absent entries as zeros.

    For a bounded set of rows (cluster means, samples; more than ``limit`` are an error): the result has a row for every two of them that
    share a column. From inner products over shared columns and each row's own sums; rows without a shared column have no entry.
    """
    x = x if rows is None else x.join(rows, row, "left_semi")
    bounded(x, row, limit)
    a = x.select(F.col(row).alias("row_a"), F.col(col).alias("__c"), F.col(value).cast("double").alias("__x"))
    b = x.select(F.col(row).alias("row_b"), F.col(col).alias("__c"), F.col(value).cast("double").alias("__y"))
    dot = a.join(b, "__c").filter("row_a < row_b").groupBy("row_a", "row_b").agg(F.sum(F.col("__x") * F.col("__y")).alias("xy"), F.sum(F.abs(F.col("__x") - F.col("__y")) - F.abs("__x") - F.abs("__y")).alias("d"))
    own = x.groupBy(row).agg(F.sum(value).cast("double").alias("s"), F.sum(F.abs(value)).cast("double").alias("m"), F.sum(F.col(value) * F.col(value)).cast("double").alias("q"))
    n = float(x.select(col).distinct().count())
    side = lambda s: own.select(F.col(row).alias(f"row_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in ("s", "m", "q")])
    p = dot.join(side("a"), "row_a").join(side("b"), "row_b")
    cov = n * F.col("xy") - F.col("s_a") * F.col("s_b")
    sd = F.sqrt((n * F.col("q_a") - F.col("s_a") ** 2) * (n * F.col("q_b") - F.col("s_b") ** 2))
    return p.select("row_a", "row_b", (F.col("m_a") + F.col("m_b") + F.col("d")).alias("manhattan"), (F.col("q_a") + F.col("q_b") - 2 * F.col("xy")).alias("euclidean_2"), (1 - F.try_divide(cov, sd)).alias("correlation"))


# ---------------------------------------------------------------- clusters


def consensus(labels: DataFrame, run: str, item: str, label: str, limit: int = 5_000) -> DataFrame:
    """``item_a < item_b, distance``: 1 less the share of all runs that put both in one cluster.

    For the bounded set of items of a consensus study (more than ``limit`` are an error). Pairs that no run joins (distance 1) have no row.
    """
    bounded(labels, item, limit)
    n = labels.select(run).distinct().count()
    a = labels.select(run, label, F.col(item).alias("item_a"))
    b = labels.select(run, label, F.col(item).alias("item_b"))
    both = a.join(b, [run, label]).filter("item_a < item_b").groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("n"))
    return both.select("item_a", "item_b", (1 - F.col("n") / float(max(n, 1))).alias("distance"))


def nearest_label(distances: DataFrame, row: str, other: str, label: str, distance: str, share: float = 1.0) -> DataFrame:
    """Each row's label of its nearest labelled neighbour (ties by the neighbour), null beyond the percentile of nearest distances."""
    best = distances.groupBy(row).agg(F.min(F.struct(F.col(distance), F.col(other), F.col(label))).alias("x"))
    near = best.select(row, F.col(f"x.{distance}").alias("d"), F.col(f"x.{label}").alias("l"))
    limit = near.agg(F.percentile("d", share)).first()[0]
    return near.select(row, F.when(F.col("d") <= F.lit(limit), F.col("l")).alias(label), F.col("d").alias(distance))


def welch(x: DataFrame, gene: str, group: str, value: str, sizes: dict[str, int]) -> DataFrame:
    """Welch's t and its degrees of freedom per gene, between two groups of known sizes; absent entries are zeros."""
    (a, na), (b, nb) = sizes.items()
    s = lambda g, p: F.coalesce(F.sum(F.when(F.col(group) == g, F.col(value).cast("double") ** p)), F.lit(0.0))
    m = x.groupBy(gene).agg(s(a, 1).alias("sa"), s(a, 2).alias("qa"), s(b, 1).alias("sb"), s(b, 2).alias("qb"))
    mean_a, mean_b = F.col("sa") / na, F.col("sb") / nb
    va, vb = (F.col("qa") - F.col("sa") * mean_a) / (na - 1) / na, (F.col("qb") - F.col("sb") * mean_b) / (nb - 1) / nb
    t = F.try_divide(mean_a - mean_b, F.sqrt(va + vb))
    df = F.try_divide((va + vb) ** 2, va**2 / (na - 1) + vb**2 / (nb - 1))
    return m.select(gene, mean_a.alias("mean_a"), mean_b.alias("mean_b"), t.alias("t"), df.alias("df"))


def _t_tail(t: float, df: float) -> float:
    """Two-sided p of Student's t, by the continued fraction of the incomplete beta function."""
    if t != t or df != df:
        return float("nan")
    x = df / (df + t * t)
    a, b = df / 2, 0.5
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / (c if abs(c) > tiny else tiny)
            h *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return h


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([_t_tail(abs(a), b) if a is not None and b is not None else None for a, b in zip(t, df)])


def ranked_by_welch(tests: DataFrame) -> DataFrame:
    """``welch`` with its two-sided p and a rank by p, then by the size of t."""
    ship(tests.sparkSession)
    p = tests.withColumn("p", t_pvalue("t", "df")).filter("t IS NOT NULL")
    return p.withColumn("rank_no", F.row_number().over(Window.orderBy("p", F.desc(F.abs("t")), tests.columns[0])))


def nmi(labels: DataFrame, a: str, b: str) -> DataFrame:
    """One row: normalised mutual information of two labelings (over the geometric mean of entropies), from the contingency table."""
    cells = labels.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    w = lambda *c: F.sum("n").over(Window.partitionBy(*c))
    p = cells.select(a, b, (F.col("n") / w()).alias("p"), (w(a) / w()).alias("pa"), (w(b) / w()).alias("pb"))
    p = p.select("p", (F.col("p") * F.log(F.col("p") / (F.col("pa") * F.col("pb")))).alias("mi"), (-F.col("p") * F.log("pa")).alias("ha"), (-F.col("p") * F.log("pb")).alias("hb"))
    return p.agg(F.try_divide(F.sum("mi"), F.sqrt(F.sum("ha") * F.sum("hb"))).alias("nmi"))


def matched_accuracy(labels: DataFrame, a: str, b: str, limit: int = 250_000) -> float:
    """Share of rows on the best one-to-one matching of labels. The contingency table, one row per pair of labels, goes to the driver; more than ``limit`` are an error."""
    cells = {(r[0], r[1]): r[2] for r in labels.groupBy(a, b).agg(F.count(F.lit(1)).alias("n")).limit(limit + 1).collect()}
    if len(cells) > limit:
        raise ValueError(f"{a} and {b} have more than {limit} pairs of labels")
    rows, cols = sorted({k[0] for k in cells}, key=repr), sorted({k[1] for k in cells}, key=repr)
    n = max(len(rows), len(cols))
    cost = np.zeros((n, n))
    for (r, c), v in cells.items():
        cost[rows.index(r), cols.index(c)] = -v
    total = sum(cells.values())
    return -_assignment(cost) / total if total else 0.0


def _assignment(cost: np.ndarray) -> float:
    """Least cost of a perfect matching (shortest augmenting paths)."""
    n = len(cost)
    u, v, match = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1, dtype=int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, used, way = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=bool), np.zeros(n + 1, dtype=int)
        while True:
            used[j0] = True
            i0 = match[j0]
            free = np.flatnonzero(~used[1:]) + 1
            cur = cost[i0 - 1, free - 1] - u[i0] - v[free]
            better = cur < least[free]
            least[free[better]] = cur[better]
            way[free[better]] = j0
            j1 = free[np.argmin(least[free])]
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    return float(sum(cost[match[j] - 1, j - 1] for j in range(1, n + 1)))


def stability(sweep: DataFrame, run: str, original: str, again: str, item: str, least: float = 0.6, share: float = 0.8) -> DataFrame:
    """Per original cluster: the mean of its best Jaccard index over the runs, and whether it is stable.

    ``sweep`` has each item's cluster before and after in each run. Stable: an index of at least ``least`` in at least ``share`` of the runs.
    """
    both = sweep.groupBy(run, original, again).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(run, original))
    after = F.sum("n").over(Window.partitionBy(run, again))
    best = both.withColumn("j", F.col("n") / (before + after - F.col("n"))).groupBy(run, original).agg(F.max("j").alias("j"))
    return best.groupBy(original).agg(F.avg("j").alias("mean_jaccard"), (F.avg((F.col("j") >= least).cast("double")) >= share).alias("is_stable"))


# ---------------------------------------------------------------- splitting and merging, on a bounded distance matrix


def complete_linkage(distance: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges of complete linkage, by nearest-neighbour chains; clusters are numbered on from the items."""
    n = len(distance)
    d = distance.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    name, size, out, chain, alive = list(range(n)), n, [], [], np.ones(n, dtype=bool)
    for _ in range(n - 1):
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        while True:
            i = chain[-1]
            row = np.where(alive, d[i], np.inf)
            j = int(np.argmin(row))
            if len(chain) > 1 and row[chain[-2]] <= row[j]:
                j = chain[-2]
                break
            chain.append(j)
        i, j = chain.pop(), chain.pop()
        a, b = min(i, j), max(i, j)
        out.append((name[a], name[b], float(d[a, b])))
        d[a] = np.maximum(d[a], d[b])
        d[:, a] = d[a]
        d[a, a] = np.inf
        alive[b] = False
        name[a], size = size, size + 1
    return out


def dendro_split(values: np.ndarray, threshold: float = 10.0, least: int = 2) -> np.ndarray:
    """Clusters of rows: the tree of complete linkage on correlation distance is cut from the top as long as the cut separates.

    A cut separates if the best gene's -log10 p of Welch's test reaches ``threshold`` and the clusters lie
    farther from each other than within themselves (medians). Parts smaller than ``least`` are single rows, labelled -1.
    """
    return cut_history(split_history(values, threshold, least), threshold, len(values), least)


def split_history(values: np.ndarray, lowest: float, least: int = 2) -> dict[int, tuple[list[int], tuple[int, int] | None, float]]:
    """The nodes that a cut at ``lowest`` or any higher threshold can reach, the top first: rows, children, and the threshold up to which the node splits."""
    n = len(values)
    if n < 2:
        return {}
    distance = correlation_distance(values)
    members: dict[int, list[int]] = {i: [i] for i in range(n)}
    children: dict[int, tuple[int, int]] = {}
    for k, (a, b, _) in enumerate(complete_linkage(distance)):
        members[n + k] = members[a] + members[b]
        children[n + k] = (a, b)
    todo, history = [2 * n - 2], {}
    while todo:
        node = todo.pop()
        upto = -math.inf
        if node in children:
            a, b = (members[c] for c in children[node])
            if min(len(a), len(b)) < least:
                upto = math.inf
            elif (score := split_score(values, a, b)) >= lowest and _lie_apart(distance, a, b):
                upto = score
            if upto >= lowest:
                todo.extend(children[node])
        history[node] = (members[node], children.get(node), upto)
    return history


def cut_history(history: dict[int, tuple[list[int], tuple[int, int] | None, float]], threshold: float, n: int, least: int = 2) -> np.ndarray:
    """Labels of the ``n`` rows by a cut of ``split_history`` at a threshold not below its lowest."""
    labels = np.full(n, -1)
    todo, number = [*history][:1], 0
    while todo:
        rows, children, upto = history[todo.pop()]
        if len(rows) < least:
            continue
        if children is not None and upto >= threshold:
            todo.extend(children)
            continue
        labels[rows] = number
        number += 1
    return labels


def correlation_distance(values: np.ndarray) -> np.ndarray:
    c = values - values.mean(axis=1, keepdims=True)
    norm = np.sqrt((c * c).sum(axis=1))
    norm[norm == 0] = 1.0
    return 1 - (c / norm[:, None]) @ (c / norm[:, None]).T


def split_score(values: np.ndarray, a: list[int], b: list[int]) -> float:
    """-log10 of the best gene's two-sided Welch p between two sets of rows."""
    if min(len(a), len(b)) < 2:
        return 0.0
    x, y = values[a], values[b]
    va, vb = x.var(axis=0, ddof=1) / len(a), y.var(axis=0, ddof=1) / len(b)
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.abs(x.mean(axis=0) - y.mean(axis=0)) / np.sqrt(va + vb)
        df = (va + vb) ** 2 / (va**2 / (len(a) - 1) + vb**2 / (len(b) - 1))
    good = np.flatnonzero(np.isfinite(t) & np.isfinite(df))
    if not len(good):
        return 0.0
    best = good[np.argsort(-t[good])[:5]]
    return -math.log10(max(min(_t_tail(float(t[i]), float(df[i])) for i in best), 1e-300))


def _lie_apart(distance: np.ndarray, a: list[int], b: list[int]) -> bool:
    within = np.concatenate([distance[np.ix_(s, s)][np.triu_indices(len(s), 1)] for s in (a, b)])
    return not len(within) or float(np.median(distance[np.ix_(a, b)])) > float(np.median(within))


def dendro_merge(values: np.ndarray, labels: np.ndarray, threshold: float = 10.0) -> np.ndarray:
    """Clusters joined, the least distinct two first, until every two of them differ by ``threshold``. A score is kept until one of its two changes."""
    out = labels.copy()
    rows = {int(k): np.flatnonzero(out == k) for k in np.unique(out) if k >= 0}
    names = sorted(rows)
    scored = {(p, q): split_score(values, rows[p], rows[q]) for i, p in enumerate(names) for q in names[i + 1 :]}
    while low := [(s, p, q) for (p, q), s in scored.items() if s < threshold]:
        _, p, q = min(low)
        rows[p] = np.union1d(rows[p], rows.pop(q))
        scored = {k: s for k, s in scored.items() if q not in k} | {(min(p, k), max(p, k)): split_score(values, rows[min(p, k)], rows[max(p, k)]) for k in rows if k != p}
        out[rows[p]] = p
    return out


def split_groups(vectors: DataFrame, group: str, item: str, column: str, threshold: float = 10.0, merge: bool = True, limit: int = MOST_ITEMS) -> DataFrame:
    """``group, item, cluster``: ``dendro_split`` (and merge) within each group of at most ``limit`` items; larger groups are an error."""
    ship(vectors.sparkSession)
    size = vectors.groupBy(group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if size > limit:
        raise ValueError(f"a group has {size} items; linkage is for at most {limit}")

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(item)
        x = np.stack(g[column].to_numpy()).astype(float)
        labels = dendro_split(x, threshold)
        if merge:
            labels = dendro_merge(x, labels, threshold)
        return pd.DataFrame({group: g[group], item: g[item], "cluster": labels})

    types = dict(vectors.dtypes)
    return vectors.select(group, item, column).groupBy(group).applyInPandas(run, f"{group} {types[group]}, {item} {types[item]}, cluster int")


def split_sweep(vectors: DataFrame, group: str, item: str, column: str, thresholds: list[float], limit: int = MOST_ITEMS) -> DataFrame:
    """``group, threshold, clusters``: the number of clusters (single rows aside) that ``dendro_split`` gives at each threshold.

    Each group of at most ``limit`` items has one linkage and one history of splits, cut at every threshold; larger groups are an error.
    """
    ship(vectors.sparkSession)
    size = vectors.groupBy(group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if size > limit:
        raise ValueError(f"a group has {size} items; linkage is for at most {limit}")

    def run(g: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(g.sort_values(item)[column].to_numpy()).astype(float)
        history = split_history(x, min(thresholds))
        found = [len({*cut_history(history, t, len(x))} - {-1}) for t in thresholds]
        return pd.DataFrame({group: g[group].iloc[0], "threshold": thresholds, "clusters": found})

    return vectors.select(group, item, column).groupBy(group).applyInPandas(run, f"{group} {dict(vectors.dtypes)[group]}, threshold double, clusters int")


def plateau(scores: list[tuple[float, int]]) -> float:
    """The first threshold of the longest run of thresholds that give one number of clusters."""
    best, at, i = 0, scores[0][0], 0
    while i < len(scores):
        j = i
        while j < len(scores) and scores[j][1] == scores[i][1]:
            j += 1
        if j - i > best:
            best, at = j - i, scores[i][0]
        i = j
    return at


# ---------------------------------------------------------------- gene ranking by models


def ranked_features(df: DataFrame, features: list[str], label: str, method: str = "forest", seed: int = 1) -> DataFrame:
    """``feature, importance``: by a random forest, or by the size of an L1-penalised logistic regression's weights."""
    v = VectorAssembler(inputCols=features, outputCol="__v").transform(df.select(*features, F.col(label).cast("double").alias("__y")))
    if method == "forest":
        weights = RandomForestClassifier(featuresCol="__v", labelCol="__y", numTrees=20, seed=seed).fit(v).featureImportances.toArray()
    else:
        weights = np.abs(LogisticRegression(featuresCol="__v", labelCol="__y", elasticNetParam=1.0, regParam=0.01).fit(v).coefficientMatrix.toArray()).max(axis=0)
    return df.sparkSession.createDataFrame([(f, float(w)) for f, w in zip(features, weights)], "feature string, importance double")


def counts_to_profile(x: DataFrame, cell: str, gene: Column, value: str) -> DataFrame:
    """Counts summed to plain gene names, to ten thousand per cell, log10 of value + 1: the input of a cell classifier."""
    plain = x.groupBy(cell, gene.alias("gene")).agg(F.sum(value).alias("n"))
    return normalised(plain, cell, "n", 10_000.0, "10").select(cell, "gene", "x")


# ---------------------------------------------------------------- further kernels, on bounded matrices


def nonnegative_factors(values: np.ndarray, k: int, rounds: int = 200, seed: int = 1) -> np.ndarray:
    """Row weights of a non-negative factorisation with ``k`` parts (multiplicative updates)."""
    rnd = np.random.default_rng(seed)
    w, h = rnd.random((len(values), k)) + 0.1, rnd.random((k, values.shape[1])) + 0.1
    for _ in range(rounds):
        h *= (w.T @ values) / np.maximum(w.T @ w @ h, 1e-12)
        w *= (values @ h.T) / np.maximum(w @ h @ h.T, 1e-12)
    return w


def independent_components(values: np.ndarray, k: int, rounds: int = 200, seed: int = 1) -> np.ndarray:
    """``k`` independent components of the rows (fixed-point iteration with tanh, on whitened data)."""
    x = values - values.mean(axis=0)
    z = np.linalg.svd(x, full_matrices=False)[0][:, :k] * math.sqrt(len(x))
    w = np.linalg.qr(np.random.default_rng(seed).normal(size=(z.shape[1], z.shape[1])))[0]
    for _ in range(rounds):
        g = np.tanh(z @ w.T)
        new = g.T @ z / len(z) - np.diag((1 - g * g).mean(axis=0)) @ w
        p, _, q = np.linalg.svd(new)
        new = p @ q
        done = np.max(np.abs(np.abs((new * w).sum(axis=1)) - 1)) < 1e-8
        w = new
        if done:
            break
    return z @ w.T


def k_medoids(distance: np.ndarray, k: int, rounds: int = 100) -> np.ndarray:
    """Labels by alternating assignment and choice of the most central row; starts from the most central rows spread out."""
    n = len(distance)
    centres = [int(np.argmin(distance.sum(axis=1)))]
    while len(centres) < min(k, n):
        centres.append(int(np.argmax(distance[:, centres].min(axis=1))))
    labels = np.argmin(distance[:, centres], axis=1)
    for _ in range(rounds):
        new = [int(np.flatnonzero(labels == c)[np.argmin(distance[np.ix_(labels == c, labels == c)].sum(axis=1))]) if (labels == c).any() else centres[c] for c in range(len(centres))]
        if new == centres:
            break
        centres = new
        labels = np.argmin(distance[:, centres], axis=1)
    return labels


def density_clusters(distance: np.ndarray, radius: float, least: int = 5) -> np.ndarray:
    """Labels by density: rows with ``least`` neighbours within the radius and all they reach; -1 for the rest."""
    near = distance <= radius
    core = near.sum(axis=1) >= least
    labels, number = np.full(len(distance), -1), 0
    for i in np.flatnonzero(core):
        if labels[i] >= 0:
            continue
        todo, labels[i] = [i], number
        while todo:
            j = todo.pop()
            if core[j]:
                for m in np.flatnonzero(near[j] & (labels < 0)):
                    labels[m] = number
                    todo.append(m)
        number += 1
    return labels


def cut_tree(distance: np.ndarray, k: int) -> np.ndarray:
    """Labels of ``k`` clusters from complete linkage."""
    n = len(distance)
    parent = list(range(n))
    members = {i: [i] for i in range(n)}
    merges = [(h, a, b, n + i) for i, (a, b, h) in enumerate(complete_linkage(distance))]
    for _, a, b, c in merges:
        members[c] = members[a] + members[b]
    for _, a, b, _ in sorted(merges)[: max(0, n - k)]:
        for x in (a, b):
            for i in members[x]:
                parent[i] = min(parent[j] for j in members[a] + members[b])
    return np.unique(np.array(parent), return_inverse=True)[1] if n else np.zeros(0, dtype=int)


def shared_neighbour_clusters(distance: np.ndarray, k: int = 10, least: float = 0.5) -> np.ndarray:
    """Labels: parts of the graph of rows that share at least ``least`` of their ``k`` nearest neighbours (themselves included)."""
    n = len(distance)
    nearest = np.argsort(distance, axis=1, kind="stable")[:, : min(k, n)]
    member = np.zeros((n, n), dtype=bool)
    np.put_along_axis(member, nearest, True, axis=1)
    shared = member.astype(np.float32) @ member.T.astype(np.float32) >= least * min(k, n)
    labels, number = np.full(n, -1), 0
    for i in range(n):
        if labels[i] < 0:
            todo, labels[i] = [i], number
            while todo:
                for m in np.flatnonzero(shared[todo.pop()] & (labels < 0)):
                    labels[m] = number
                    todo.append(m)
            number += 1
    return labels


def affinity_clusters(distance: np.ndarray, damping: float = 0.9, rounds: int = 400, patience: int = 30, preference: float | None = None) -> np.ndarray:
    """Labels by affinity propagation: rows choose exemplars by messages of responsibility and availability between near rows.

    Likeness is the negative squared distance; ``preference``, how likely each row is to be an exemplar, is by default its median. It ends when the
    exemplars haven't changed for ``patience`` rounds. Ties are broken by the rows' order. Without exemplars all rows are one cluster.
    """
    n = len(distance)
    if n < 2:
        return np.zeros(n, dtype=int)
    s = -np.asarray(distance, dtype=float) ** 2
    off = s[~np.eye(n, dtype=bool)]
    np.fill_diagonal(s, np.median(off) if preference is None else preference)
    s -= np.arange(n)[None, :] * 1e-12 * max(1.0, float(np.abs(off).max()))  # one order among equals
    r, a = np.zeros((n, n)), np.zeros((n, n))
    index, last, same = np.arange(n), None, 0
    for _ in range(rounds):
        both = a + s
        best = both.argmax(axis=1)
        first = both[index, best]
        both[index, best] = -np.inf
        second = both.max(axis=1)
        new = s - first[:, None]
        new[index, best] = s[index, best] - second
        r = damping * r + (1 - damping) * new
        gain = np.maximum(r, 0)
        gain[index, index] = r[index, index]
        total = gain.sum(axis=0)
        new = total[None, :] - gain
        own = new[index, index].copy()
        new = np.minimum(new, 0)
        new[index, index] = own
        a = damping * a + (1 - damping) * new
        exemplars = (a + r)[index, index] > 0
        same = same + 1 if last is not None and (exemplars == last).all() else 0
        last = exemplars
        if same >= patience and exemplars.any():
            break
    chosen = np.flatnonzero(last)
    if not len(chosen):
        return np.zeros(n, dtype=int)
    label = s[:, chosen].argmax(axis=1)
    label[chosen] = np.arange(len(chosen))
    return label


def on_groups(vectors: DataFrame, group: str, item: str, column: str, kernel, limit: int = MOST_ITEMS, out: str = "label int") -> DataFrame:
    """``group, item`` and what ``kernel`` gives for the matrix of each group of at most ``limit`` items, in order of the items; larger groups are an error."""
    ship(vectors.sparkSession)
    size = vectors.groupBy(group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if size > limit:
        raise ValueError(f"a group has {size} items; this is for at most {limit}")
    name = out.split()[0]

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(item)
        return pd.DataFrame({group: g[group], item: g[item], name: list(kernel(np.stack(g[column].to_numpy()).astype(float)))})

    types = dict(vectors.dtypes)
    return vectors.select(group, item, column).groupBy(group).applyInPandas(run, f"{group} {types[group]}, {item} {types[item]}, {out}")
