"""Numeric and sampling operators against plain computations and invariants."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import matrix, molecules as mo, sets, stats, windows


def test_samples(spark):
    df = spark.range(5_000).withColumn("g", F.col("id") % 7)
    assert sets.sample_exactly(df, ["id"], 123).count() == 123
    assert {r.id for r in sets.sample_exactly(df, ["id"], 50).collect()} == {r.id for r in sets.sample_exactly(df.repartition(9), ["id"], 50).collect()}
    share = sets.sample_share(df, ["id"], 0.3)
    assert 1_350 < share.count() < 1_650 and share.count() == sets.sample_share(df.repartition(5), ["id"], 0.3).count()
    by = {r.g: r["count"] for r in sets.sample_by_group(df, "g", ["id"], 0.1).groupBy("g").count().collect()}
    sizes = {r.g: r["count"] for r in df.groupBy("g").count().collect()}
    assert by == {g: math.ceil(n * 0.1) for g, n in sizes.items()}


def test_saturation_curve(spark):
    rnd = random.Random(1)
    rows = [(i, f"g{int(rnd.paretovariate(0.6)) % 400}") for i in range(4_000)]
    curve = windows.saturation_curve(spark.createDataFrame(rows, "r long, gene string"), "r", "gene").orderBy("step").collect()
    assert curve[-1].depth == 4_000 and curve[-1].detected == len({g for _, g in rows})
    for a, b in zip(curve, curve[1:]):
        assert a.depth <= b.depth and a.detected <= b.detected
    # all depths together hold every read once
    assert [r.step for r in curve] == list(range(100))


def test_doublets_against_percentiles(spark):
    rnd = random.Random(2)
    cells = {c: [int(rnd.paretovariate(1.2)) for _ in range(n)] for c, n in (("a", 900), ("b", 500), ("c", 30))}
    bars = spark.createDataFrame([("g", c, v) for c, vs in cells.items() for v in vs], "gene string, cell string, count long").groupBy("gene", "cell", "count").agg(F.count(F.lit(1)).alias("freq"))
    want = 0
    for vs in cells.values():
        if len(vs) > 400:
            rate = round(mo.doublet_rate(len(vs)), 3)
            want += sum(v > np.percentile(vs, (1 - rate) * 100) for v in vs)
    assert mo._doublets(bars, "gene", "cell", 65_536, 400).first().doublets == want


def test_components_against_svd(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(60, 4)) @ np.diag([5, 3, 1, 0.2])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i int, v array<double>")
    got = np.array([r.components for r in matrix.principal_components(df, "v", 2).orderBy("i").collect()])
    _, s, vt = np.linalg.svd(x - x.mean(axis=0))
    want = x @ vt[:2].T
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-8)
    assert matrix.explained_variance(df, "v", 2) == pytest.approx((s**2 / (s**2).sum())[:2])


def test_k_means_and_plateau(spark):
    rnd = np.random.default_rng(4)
    x = np.concatenate([c + rnd.normal(0, 0.1, (30, 2)) for c in ([0, 0], [5, 5], [0, 9])])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i int, v array<double>")
    labels = [r.cluster for r in matrix.k_means(df, "v", 3).orderBy("i").collect()]
    assert all(len({*labels[a : a + 30]}) == 1 for a in (0, 30, 60)) and len({*labels}) == 3
    assert matrix.plateau([(10, 9), (15, 5), (20, 5), (25, 5), (30, 1), (35, 1)]) == 15


def test_module_score_by_hand(spark):
    rnd = random.Random(5)
    genes, cells = [f"g{i}" for i in range(30)], [f"c{i}" for i in range(12)]
    x = {(c, g): rnd.randrange(1, 9) for c in cells for g in genes if rnd.random() < 0.6}
    df = spark.createDataFrame([(c, g, n) for (c, g), n in x.items()], "cell string, gene string, n int")
    feats = spark.createDataFrame([("g1",), ("g2",), ("g3",)], "gene string")
    got = {r.cell: r.score for r in stats.module_score(df, feats, "cell", "gene", "n", len(cells), bins=1, controls=100).collect()}
    seen = sorted({g for _, g in x})
    for c in got:
        f = sum(x.get((c, g), 0) for g in ("g1", "g2", "g3")) / 3
        assert got[c] == pytest.approx(f - sum(x.get((c, g), 0) for g in seen) / len(seen))


def test_enrichment_by_hand(spark):
    df = lambda rows, s: spark.createDataFrame(rows, s)
    background = [(f"g{i}",) for i in range(20)]
    query = [(f"g{i}",) for i in range(6)] + [("outside",)]
    sets_ = [("s", f"g{i}") for i in (0, 1, 2, 10, 11)] + [("t", f"g{i}") for i in range(5, 15)] + [("u", "g19"), ("s", "outside")]
    got = {r.set_id: r for r in stats.enrichment(df(query, "gene string"), df(sets_, "set_id string, gene string"), "set_id", "gene", df(background, "gene string")).collect()}
    assert set(got) == {"s", "t"}
    for name, k, size in (("s", 3, 5), ("t", 1, 10)):
        p = sum(math.comb(size, i) * math.comb(20 - size, 6 - i) for i in range(k, min(6, size) + 1)) / math.comb(20, 6)
        assert (got[name].k, got[name].k_set, got[name].n, got[name].n_all) == (k, size, 6, 20) and got[name].p == pytest.approx(p)
        assert got[name].q >= got[name].p


def test_bootstrap_shares(spark):
    df = spark.createDataFrame([("a", "x", 400), ("a", "y", 600), ("b", "x", 10)], "g string, k string, n long")
    got = {(r.g, r.k): r for r in stats.bootstrap_shares(df, "g", "k", "n", 400).collect()}
    r = got[("a", "x")]
    assert r.share == 0.4 and 0.34 < r.low < 0.39 and 0.41 < r.high < 0.46
    assert got[("b", "x")].share == got[("b", "x")].low == got[("b", "x")].high == 1.0
    assert 0.34 < r.bca_low < 0.39 and 0.41 < r.bca_high < 0.46 and got[("b", "x")].bca_low == 1.0
    # Of a rare kind the corrected limits lie above the plain ones: its draws are skewed to the right.
    rare = {q.k: q for q in stats.bootstrap_shares(spark.createDataFrame([("a", "x", 4), ("a", "y", 196), ("b", None, 0)], "g string, k string, n long"), "g", "k", "n", 20_000).collect()}
    assert rare["x"].bca_low >= rare["x"].low and rare["x"].bca_high > rare["x"].high and rare[None].share is None


def test_rank_sum_by_hand(spark):
    rnd = random.Random(7)
    rows = [("g", rnd.random() < 0.4, rnd.randrange(5)) for _ in range(60)]
    r = stats.rank_sum(spark.createDataFrame(rows, "gene string, grp boolean, v int"), "gene", "grp", "v").first()
    a, b = [v for _, g, v in rows if g], [v for _, g, v in rows if not g]
    assert r.u == sum((x > y) + 0.5 * (x == y) for x in a for y in b)


def test_sweep_over_every_threshold(spark):
    from tallyloom.plans.registry import QUERIES

    rnd = np.random.default_rng(5)
    centre = rnd.normal(0, 1, (6, 12))
    x = np.concatenate([c * w + rnd.normal(0, s, (20, 12)) for c, w, s in zip(centre, (1, 1, 2, 2, 3, 3), (0.9, 0.5, 0.5, 0.3, 0.3, 0.2))])
    df = spark.createDataFrame([(0, i, [float(v) for v in r]) for i, r in enumerate(x)], "g int, i int, v array<double>")
    thresholds = [float(t) for t in range(2, 60, 3)]
    got = [r.clusters for r in matrix.split_sweep(df, "g", "i", "v", thresholds).orderBy("threshold").collect()]
    assert got == [len({*matrix.dendro_split(x, t)} - {-1}) for t in thresholds] and len({*got}) > 2
    rows = sorted(QUERIES["D14_threshold_sweep"](spark, "/root/testdata/sf0.001").collect())
    assert [r.threshold for r in rows] == [10.0 + 5 * k for k in range(22)]
    assert [r.threshold for r in rows if r.chosen] == [matrix.plateau([(r.threshold, r.clusters) for r in rows])]


@pytest.mark.parametrize("name", ["D05_nonnegative_factors", "D05_independent_components", "D07_k_medoids", "D07_density_clusters", "D07_hierarchical_clusters", "D07_shared_neighbour_clusters", "D09_dendro_split", "D10_dendro_merge"])
def test_kernels_see_all_vectors(spark, name):
    from tallyloom.plans.registry import QUERIES
    from tallyloom.plans.tables import read

    sf = "/root/testdata/sf0.001"
    x = np.stack([r.embedding for r in read(spark, sf, "embeddings").orderBy("vec_id").collect()]).astype(float)
    d = matrix.correlation_distance(x)
    want = {
        "D05_nonnegative_factors": lambda: matrix.nonnegative_factors(x - x.min(), 3),
        "D05_independent_components": lambda: matrix.independent_components(x, 3),
        "D07_k_medoids": lambda: matrix.k_medoids(d, 8),
        "D07_density_clusters": lambda: matrix.density_clusters(d, 0.7, 4),
        "D07_hierarchical_clusters": lambda: matrix.cut_tree(d, 8),
        "D07_shared_neighbour_clusters": lambda: matrix.shared_neighbour_clusters(d),
        "D09_dendro_split": lambda: matrix.dendro_split(x, 4.0),
        "D10_dendro_merge": lambda: matrix.dendro_merge(x, matrix.dendro_split(x, 4.0), 4.0),
    }[name]()
    rows = QUERIES[name](spark, sf).orderBy("vec_id").collect()
    assert {r.part for r in rows} == {0} and np.allclose([r[2] for r in rows], want)


def test_distances_over_all_dimensions(spark):
    from tallyloom.plans.registry import QUERIES
    from tallyloom.plans.tables import read

    sf = "/root/testdata/sf0.001"
    by = {}
    for r in read(spark, sf, "embeddings").collect():
        by.setdefault(r.label, []).append(r.embedding)
    m = {k: np.mean(np.array(v, dtype=float), axis=0) for k, v in by.items()}
    for r in QUERIES["D06_whole_distances"](spark, sf).collect():
        a, b = m[r.row_a], m[r.row_b]
        assert (r.manhattan, r.euclidean_2, r.correlation) == pytest.approx((np.abs(a - b).sum(), ((a - b) ** 2).sum(), 1 - np.corrcoef(a, b)[0, 1]), abs=2e-6)
    rows = QUERIES["D11_whole_nearest_label"](spark, sf).collect()
    assert all(r.distance == pytest.approx(min(1 - np.corrcoef(m[r.row_no], v)[0, 1] for k, v in m.items() if k != r.row_no), abs=2e-6) for r in rows)
    assert 0 < sum(r.label is None for r in rows) < len(rows)


def test_affinity_clusters():
    rnd = np.random.default_rng(3)
    x = np.concatenate([rnd.normal(c, 0.1, (n, 2)) for c, n in (((0, 0), 12), ((5, 0), 9), ((0, 5), 15))])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    got = matrix.affinity_clusters(d)
    truth = [0] * 12 + [1] * 9 + [2] * 15
    assert len({*got}) == 3 and len({*zip(got, truth)}) == 3
    assert matrix.affinity_clusters(np.zeros((0, 0))).tolist() == [] and matrix.affinity_clusters(np.zeros((1, 1))).tolist() == [0]
    assert len(matrix.affinity_clusters(np.zeros((5, 5)))) == 5
