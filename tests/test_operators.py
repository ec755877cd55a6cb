"""Operators on fixtures: golden cases and invariants."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import reads as rd
from tallyloom.operators import cells, joins, labels, matrix, molecules as mo, receptors, stats, tags, windows

# ---------------------------------------------------------------- reads


def _one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("seq", "passes"),
    [
        # Golden cases.
        ("GCGCAATCAACTGGCCTGCGACCGACAAGAGGTAGCGGTGACGAAGGGTCAGCGTAATTTTTTTTTTTTTTTTTTT", True),
        ("AGAACTTCCACTGGCCTGCGACAGAAATCGGGTAGCGGTGACACAGGGAGGGATCAATAATTTTTTTTTTCCATTG", True),
        ("TAGCTTGTAACTGGCCTTTTTTTTTTTTTTTTTTTTTTTAGAACAGGGTAATTTTTTTTTTGTAAAAACAACTGTG", False),
        ("A" * 66, True),
    ],
)
def test_poly_t(spark, seq, passes):
    assert _one(spark, seq, lambda c: rd.poly_t_passes(F.substring(c, 61, 100))) is passes


@pytest.mark.parametrize(("cigar", "n"), [("10M2I30M", 40), ("5S", 0), ("", 0), (None, None), ("100M", 100)])
def test_cigar(spark, cigar, n):
    assert _one(spark, cigar, rd.matched_length) == n


@pytest.mark.parametrize(("umi", "ok"), [("A" * 8, True), ("A" * 12, True), ("A" * 20, True), ("A" * 9, False), ("AAAANAAA", False), ("", False), (None, False)])
def test_umi_validity(spark, umi, ok):
    assert _one(spark, umi, rd.umi_is_valid) is ok


@pytest.mark.parametrize(("name", "plain"), [("AIM2|NM_004833.1|Reference_end", "AIM2"), ("CD3:1234|CD3|pAbO", "CD3" + rd.PROTEIN_MARK), ("A", "A")])
def test_gene_names(spark, name, plain):
    assert _one(spark, name, rd.plain_gene_name) == plain


def test_checksum_repairs_any_substitution(spark):
    def encode(d):  # places 3, 5, 6, 7 hold data, the others make the sums 0 modulo 4
        c = [0] * 8
        c[2], c[4], c[5], c[6] = d
        c[0] = -(c[2] + c[4] + c[6]) % 4
        c[1] = -(c[2] + c[5] + c[6]) % 4
        c[3] = -(c[4] + c[5] + c[6]) % 4
        c[7] = -sum(c[:7]) % 4
        return c

    rows = []
    for d in [(0, 1, 2, 3), (3, 3, 1, 0), (2, 2, 2, 2)]:
        c = encode(d)
        good = "".join("ACGT"[x] for x in c)
        rows.append((good, good))
        for i in range(8):
            for e in (1, 2, 3):
                b = c.copy()
                b[i] = (b[i] + e) % 4
                rows.append(("".join("ACGT"[x] for x in b), good))
    df = spark.createDataFrame([*rows, ("ACGTNACG", None), ("ACG", None)], "bad string, good string")
    assert df.filter(~rd.repair_checksum(F.col("bad")).eqNullSafe(F.col("good"))).count() == 0


def test_quality(spark):
    assert _one(spark, "!I", rd.mean_quality) == 20.0
    assert _one(spark, "", rd.mean_quality) is None
    assert _one(spark, "AAAT", rd.top_base_share) == 0.75


# ---------------------------------------------------------------- identifiers


@pytest.mark.parametrize(
    ("counts", "totals"),
    [
        ({"AAAA": 10, "AAAT": 5}, {"AAAA": 15}),
        ({"AAAA": 10, "AAAT": 6}, {"AAAA": 10, "AAAT": 6}),
        ({"AAAA": 40, "AAAT": 20, "AATT": 10}, {"AAAA": 70}),
        ({"AAAA": 30, "TTAT": 20, "TAAT": 5, "AAAT": 10}, {"AAAA": 45, "TTAT": 20}),
        ({"AAAA": 10, "TTTT": 1}, {"AAAA": 10, "TTTT": 1}),
    ],
)
def test_umi_clusters(spark, counts, totals):
    parent = mo.cluster_umis(counts)
    got = {}
    for u, p in parent.items():
        got[p] = got.get(p, 0) + counts[u]
    assert got == totals
    df = spark.createDataFrame([("c", "g", u, n) for u, n in counts.items()], "cell string, gene string, umi string, raw_reads int")
    rows = mo.correct_substitutions(df, ["cell", "gene"]).collect()
    assert {r.umi: r.rsec_reads for r in rows if r.rsec_reads} == totals
    assert all((r.parent_umi is None) == (r.rsec_reads > 0) for r in rows)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("AC", min_size=4, max_size=4), st.integers(1, 50), max_size=16))
def test_clusters_keep_reads_and_parents_lead(counts):
    parent = mo.cluster_umis(counts)
    assert set(parent) == set(counts)
    for u, p in parent.items():
        assert parent[p] == p and counts[p] >= counts[u]


def test_neighbours_against_all_pairs(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("xy"), "".join(rnd.choice("ACG") for _ in range(rnd.choice([4, 5])))) for _ in range(80)]
    df = spark.createDataFrame(rows, "k string, umi string")
    want = {(a[0], a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and len(a[1]) == len(b[1]) and a[1] < b[1] and sum(x != y for x, y in zip(a[1], b[1])) <= 1}
    assert {tuple(r) for r in mo.neighbour_pairs(df, ["k"]).collect()} == want


def test_depth_branches_and_cutoffs(spark):
    rows = [("low", "c", 1)] * 5 + [("none", "c", n) for n in (5, 6, 7)] + [("shallow", "c", n) for n in (1, 2, 3)]
    rows += [("two", "c", n) for n in [1] * 400 + [2] * 60 + [3] * 5 + [n for n in range(15, 46) for _ in range(6)]]
    df = spark.createDataFrame(rows, "gene string, cell string, rsec_reads int")
    got = {r.gene: (r.branch, r.status, r.cutoff) for r in mo.depth_cutoffs(df).collect()}
    assert got["low"] == ("low_depth", "low_depth", 0)
    assert got["shallow"][0] == "low_depth"
    assert got["none"] == ("no_singletons", "pass", 0)
    assert got["two"][:2] == ("fit", "pass") and 3 <= got["two"][2] <= 15
    marked = mo.apply_cutoffs(df.withColumn("parent_umi", F.lit(None).cast("string")), mo.depth_cutoffs(df))
    assert marked.filter("gene = 'two' AND rsec_reads = 1 AND (dbec_reads != 0 OR corrected_umi != 'NNNNNNN')").count() == 0
    assert marked.filter("dbec_reads > rsec_reads").count() == 0


def test_log_gamma():
    x = [0.5, 1.0, 2.0, 3.7, 9.99, 10.0, 11.0, 250.0, 1e6]
    assert all(abs(a - math.lgamma(v)) <= 1e-9 * max(1.0, abs(math.lgamma(v))) for a, v in zip(mo._log_gamma(x), x))


def test_the_cutoff_is_an_observed_count():
    two = {1: 400.0, 2: 60.0} | {n: 6.0 for n in range(15, 46)}
    # A trimmed top doesn't change which counts are looked at.
    assert mo.separation_cutoff(two) == 15
    trimmed = mo.fitted_counts({c: int(n) for c, n in two.items()}, doublets=6 * 26)
    assert max(trimmed) == 19 and mo.separation_cutoff(trimmed, [*two]) == 15
    # After trimming 15 lies above half of what is left (19), but not above half of what was observed.
    assert mo.separation_cutoff(trimmed, [1, 2, 15, 16, 19, 45]) == 15
    # The signal leads from 7 on; the first observed count of at least that is the cutoff, or 2 if its predecessor lies above half of the greatest.
    assert [mo.separation_cutoff(two, [1, j]) for j in (6, 7, 8, 15)] == [None, 7, 8, 15]
    assert mo.separation_cutoff(two, [1, 4, 7]) == 2
    assert mo.separation_cutoff(two, [1, 4, 7, 8]) == 7
    assert mo.separation_cutoff(two, [2, 3]) is None


def test_few_counts_are_filled_from_zero():
    assert mo.fitted_counts({1: 3, 4: 2}) == {0: 1.0, 1: 300.0, 2: 1.0, 3: 1.0, 4: 200.0}
    # Filled counts are fitted, but the cutoff is one that occurs.
    few = {1: 50, 20: 9, 22: 9, 25: 9}
    assert mo.separation_cutoff(mo.fitted_counts(few), [*few]) == 20
    assert mo.separation_cutoff(mo.fitted_counts(few)) < 20


def test_many_genes_at_once_are_fitted_like_each():
    rnd = random.Random(4)
    some = [{rnd.choice([1, 2, 3, *range(8, 40)]): rnd.randrange(1, 90) for _ in range(rnd.randrange(1, 25))} for _ in range(60)]
    assert mo.separation_cutoffs(some, [[*c] for c in some]) == [mo.separation_cutoff(c) for c in some]


def test_separation_fails_on_one_peak():
    assert mo.separation_cutoff({1: 100.0}) is None
    assert mo.doublet_rate(0) == 0.0
    assert 0 < mo.doublet_rate(400) < mo.doublet_rate(40_000) < 1


# ---------------------------------------------------------------- joins


def test_overlap_join_against_all_pairs(spark):
    rnd = random.Random(2)
    left = [(k, rnd.choice("ab"), s := rnd.randrange(-50, 200), s + rnd.randrange(-3, 60)) for k in range(60)]
    right = [(k, rnd.choice("ab"), s := rnd.randrange(-50, 200), s + rnd.randrange(0, 90)) for k in range(60)] + [(99, "a", None, 5)]
    a = spark.createDataFrame(left, "l int, chrom string, start int, end int")
    b = spark.createDataFrame(right, "r int, chrom string, f_start int, f_end int")
    want = sorted((x[0], y[0]) for x in left for y in right if x[1] == y[1] and y[2] is not None and x[2] <= x[3] and x[2] <= y[3] and y[2] <= x[3])
    for width in (1, 7, 1000):
        assert sorted((r.l, r.r) for r in joins.overlap_join(a, b, ["chrom"], width).collect()) == want


def test_join_by_id_is_strict(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, a string"), spark.createDataFrame([(1, "y"), (2, "z")], "k int, b string")
    with pytest.raises(Exception, match="without a partner"):
        joins.join_by_id(a, b, "k").collect()
    assert joins.join_by_id(a, b.filter("k = 1"), "k").count() == 1


def test_nearest_whitelisted(spark):
    df = spark.createDataFrame([("AAAA",), ("AAAT",), ("CCCG",), ("GGGG",), (None,), ("",)], "v string")
    got = {r.v: (r.place, r.distance) for r in joins.nearest_whitelisted(df, "v", ["AAAA", "AATT", "CCCC"], 2).collect()}
    assert got == {"AAAA": (1, 0), "AAAT": (None, None), "CCCG": (3, 1), "GGGG": (None, None), "": (None, None)}


# ---------------------------------------------------------------- cells


def _curve(n_cells=400, n_noise=6000, seed=0):
    rnd = np.random.default_rng(seed)
    return np.sort(np.concatenate([rnd.lognormal(9, 0.25, n_cells), rnd.lognormal(2.2, 0.6, n_noise)]).astype(int))[::-1]


def test_the_knee_is_found():
    n = cells.inferred_cells(_curve())
    assert 300 <= n <= 520
    assert cells.inferred_cells(_curve()[:40]) == 0
    assert cells.inferred_cells(np.array([], dtype=int)) == 0


def test_smoothing_is_a_running_mean():
    x = np.array([np.nan, 1.0, 2, 6, 4, 5, np.nan])
    assert np.allclose(cells.smoothed(x, 3)[2:5], [3, 4, 5]) and np.isnan(cells.smoothed(x, 3)[[0, 1, 5, 6]]).all()


@pytest.mark.parametrize("assay", ["Targeted", "WTA"])
def test_cells_are_called(spark, assay):
    totals = _curve(200, 1500)
    rnd = np.random.default_rng(1)
    rows = []
    for i, t in enumerate(totals):
        k = rnd.multinomial(int(t), rnd.dirichlet(np.full(40, 0.5)))
        rows += [(f"{i}", f"g{j}", int(c), max(1, int(c) // 3)) for j, c in enumerate(k) if c]
    df = spark.createDataFrame(rows, "cell string, gene string, dbec_reads int, dbec_mols int")
    got = cells.call_cells(df, 40, assay)
    names = {int(r.cell) for r in got.collect()}
    assert 120 <= len(names) <= 320
    assert cells.call_cells(df.limit(0), 40, assay).collect() == []


# ---------------------------------------------------------------- tags


def test_tag_calls(spark):
    rnd = random.Random(4)
    rows, truth = [], {}
    for c in range(300):
        t = f"T{c % 3}"
        truth[c] = t
        rows += [(c, t, rnd.randrange(300, 600))] + [(c, f"T{o}", rnd.randrange(0, 6)) for o in range(3) if f"T{o}" != t]
    rows += [(1000, "T0", 400), (1000, "T1", 420), (1001, "T2", 2)]
    df = spark.createDataFrame(rows, "cell int, tag string, n long")
    everyone = df.select("cell").distinct().union(spark.createDataFrame([(2000,)], "cell int"))
    got = {r.cell: (r.sample_tag, r.tags) for r in tags.call_tags(df, everyone).calls.collect()}
    assert {c: got[c][0] for c in truth} == truth
    assert got[1000] == ("Multiplet", "T0;T1") and got[1001] == ("Undetermined", "") and got[2000] == ("Undetermined", "")
    none = tags.call_tags(df.limit(0), everyone).calls
    assert {r.sample_tag for r in none.collect()} == {"Undetermined"}


@pytest.mark.parametrize("bad", ["4Ramos", "4-Ra-mos", "x-Ramos", "4-", "4-R mos"])
def test_tag_names(bad):
    assert tags.tag_name("4-Ramos") == ("4", "Ramos")
    with pytest.raises(ValueError, match="not a tag name"):
        tags.tag_name(bad)


# ---------------------------------------------------------------- receptors


def test_mixture_cutoff():
    rnd = np.random.default_rng(3)
    x = np.concatenate([rnd.lognormal(0.7, 0.35, 3000), rnd.lognormal(5, 0.4, 600)]).astype(int) + 1
    v, n = np.unique(x, return_counts=True)
    assert 5 < receptors.mixture_cutoff(dict(zip(v, n.astype(float)))) < 80
    assert receptors.mixture_cutoff({1: 5.0, 2: 1.0}) is None


# ---------------------------------------------------------------- statistics


def test_adjusted_p_is_monotone(spark):
    p = [0.001, 0.01, 0.01, 0.03, 0.2, 0.9, 1.0]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(p)] + [(99, None)], "i int, p double")
    q = [r.q for r in windows.adjust_p(df, "p").orderBy("p", "i").collect()]
    n = len(p)
    want = [min(min(1.0, p[j] * n / (max(k for k in range(n) if p[k] == p[j]) + 1)) for j in range(i, n)) for i in range(n)]
    assert q == pytest.approx(want) and q == sorted(q)


def test_t_tail_and_hypergeometric():
    assert matrix._t_tail(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert matrix._t_tail(0.0, 5) == pytest.approx(1.0)
    assert matrix._t_tail(12.0, 200.5) < 1e-20
    exact = sum(math.comb(5, i) * math.comb(15, 6 - i) for i in range(3, 6)) / math.comb(20, 6)
    assert stats._tail(3, 6, 5, 20) == pytest.approx(exact)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), min_size=2, max_size=25))
def test_kendall(pairs):
    x, y = [*zip(*pairs)]
    c = d = tx = ty = 0
    for i in range(len(x)):
        for j in range(i):
            s = (x[i] - x[j]) * (y[i] - y[j])
            c, d = c + (s > 0), d + (s < 0)
            tx, ty = tx + (x[i] != x[j]), ty + (y[i] != y[j])
    got = stats.kendall([*x], [*y])
    assert math.isnan(got) if not tx * ty else got == pytest.approx((c - d) / math.sqrt(tx * ty))


def test_complete_linkage_against_plain_search():
    rnd = np.random.default_rng(5)
    x = rnd.random((14, 3))
    d = np.sqrt(((x[:, None] - x) ** 2).sum(-1))
    heights = sorted(m[2] for m in matrix.complete_linkage(d))
    sets = [{i} for i in range(14)]
    want = []
    while len(sets) > 1:
        h, i, j = min((max(d[p, q] for p in sets[i] for q in sets[j]), i, j) for i in range(len(sets)) for j in range(i))
        want.append(h)
        sets[i] |= sets[j]
        del sets[j]
    assert heights == pytest.approx(sorted(want))


def test_dendro_split_and_merge():
    rnd = np.random.default_rng(6)
    centres = rnd.random((3, 30)) * 10
    x = np.concatenate([c + rnd.normal(0, 0.3, (25, 30)) for c in centres])
    labels = matrix.dendro_split(x, 10.0)
    merged = matrix.dendro_merge(x, labels, 10.0)
    for part in (merged[:25], merged[25:50], merged[50:]):
        assert len({*part}) == 1
    assert len({*merged}) == 3
    assert {*matrix.dendro_split(rnd.normal(0, 1, (30, 5)), 50.0)} == {0}


def test_matched_accuracy(spark):
    rows = [("a", "x")] * 5 + [("a", "y")] * 2 + [("b", "x")] * 4 + [("b", "z")] + [("c", "y")] * 3
    df = spark.createDataFrame(rows, "p string, q string")
    from itertools import permutations

    n = {}
    for r in rows:
        n[r] = n.get(r, 0) + 1
    best = max(sum(n.get(z, 0) for z in zip("abc", perm)) for perm in permutations("xyz"))
    assert matrix.matched_accuracy(df, "p", "q") == pytest.approx(best / len(rows))


def test_ancestors_stop_on_cycles(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c")], "child string, parent string")
    assert {tuple(r) for r in stats.ancestors(df).collect()} == {("a", "b", 1), ("b", "c", 1), ("a", "c", 1)}
    cyclic = spark.createDataFrame([("a", "b"), ("b", "a")], "child string, parent string")
    assert {tuple(r)[:2] for r in stats.ancestors(cyclic).collect()} == {("a", "b"), ("b", "a"), ("a", "a"), ("b", "b")}


def test_running_enrichment_against_whole_walk(spark):
    rnd = random.Random(8)
    ranked = [(f"g{i:03}", rnd.uniform(-3, 3)) for i in range(120)]
    member = {s: {g for g, _ in ranked if rnd.random() < 0.2} for s in "ab"}
    got = {r.s: r.score for r in stats.running_enrichment(spark.createDataFrame(ranked, "g string, v double"), spark.createDataFrame([(s, g) for s in member for g in member[s]], "s string, g string"), "s", "g", "v").collect()}
    for s, m in member.items():
        walk, best, total = 0.0, 0.0, sum(abs(v) for g, v in ranked if g in m)
        for g, v in sorted(ranked, key=lambda x: -x[1]):
            walk += abs(v) / total if g in m else -1 / (len(ranked) - len(m))
            best = walk if abs(walk) > abs(best) else best
        assert got[s] == pytest.approx(best)


# ---------------------------------------------------------------- labels with errors


def test_label_annotation(spark):
    a, b, c = ["AAAACCCC", "GGTTGGTT"], ["CATCATCA", "TTTTGGGG"], ["ACGTACGT", "GGGGAAAA"]
    s = labels.LabelScheme([a, b, c], ("ACTGGCCTGCGA", "GGTAGCGGTGAC"), 1)
    good = a[1] + s.linkers[0] + b[0] + s.linkers[1] + c[1] + "ACACACAC" + "TTTTTTTT"
    cases = {
        "exact": (good, ("2-1-2", "0-0-0", "ACACACAC", "TTTTTTTT")),
        "substituted": ("C" + good[1:], ("2-1-2", "1-0-0", "ACACACAC", "TTTTTTTT")),
        "lost": (good[:3] + good[4:], ("2-1-2", "2-0-0", "ACACACAC", "TTTTTTTT")),
        "added": (good[:24] + "G" + good[24:], ("2-1-2", "0-2-0", "ACACACAC", "TTTTTTTT")),
        "unknown": ("T" * 64, None),
        "short": ("ACG", None),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in cases.items()] + [("none", None)], "read_id string, seq string")
    got = {r.read_id: tuple(r)[1:] for r in labels.annotate_labels(df, s).collect()}
    assert set(got) == set(cases)
    for k, (_, want) in cases.items():
        assert got[k] == want if want else "x" in got[k][0]


@settings(max_examples=200, deadline=None)
@given(st.text("ACG", max_size=9), st.text("ACG", max_size=9), st.integers(0, 9))
def test_bounded_distance(a, b, limit):
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
    assert labels.distance(a, b, limit) == min(d[-1][-1], limit + 1)


def test_clusters_of_clear_groups():
    rnd = np.random.default_rng(2)
    x = np.concatenate([c + rnd.normal(0, 0.2, (20, 12)) for c in rnd.random((3, 12)) * 9])
    d = matrix.correlation_distance(x)
    for got in (matrix.k_medoids(d, 3), matrix.density_clusters(d, 0.15, 4), matrix.cut_tree(d, 3), matrix.shared_neighbour_clusters(d)):
        parts = [{*got[i : i + 20]} for i in (0, 20, 40)]
        assert all(len(p) == 1 for p in parts) and len(set.union(*parts)) == 3
    w = matrix.nonnegative_factors(np.abs(x), 3)
    assert w.shape == (60, 3) and (w >= 0).all()
    sources = np.stack([rnd.uniform(-1, 1, 4000), np.sign(rnd.normal(size=4000)) * rnd.exponential(1, 4000)], axis=1)
    found = matrix.independent_components(sources @ rnd.normal(size=(2, 2)), 2)
    c = np.abs(np.corrcoef(sources.T, found.T)[:2, 2:])
    assert c.max(axis=1).min() > 0.95


def test_pairs_of_too_many_are_an_error(spark):
    from tallyloom.operators import sets

    df = spark.range(20).select(F.col("id").alias("s"), F.lit(1).alias("i"), F.lit(1.0).alias("v"))
    for call in (lambda: sets.jaccard(df, "s", "i", 19), lambda: matrix.pair_distances(df, "s", "i", "v", limit=19), lambda: matrix.consensus(df, "i", "s", "v", 19), lambda: stats.sample_correlations(df, "s", "i", "v", limit=19)):
        with pytest.raises(ValueError, match="more than 19"):
            call()
    assert sets.jaccard(df, "s", "i", 20).count() == 190


def test_wide_tables_hold_every_value(spark):
    from tallyloom.plans.bindings import tag_counts
    from tallyloom.plans.registry import QUERIES
    from tallyloom.plans.tables import read

    sf = "/root/testdata/sf0.001"
    tags = tag_counts(spark, sf)
    wide = QUERIES["O08_pivot_all_tags"](spark, sf)
    got = {(r.cell, c): r[c] for r in wide.collect() for c in wide.columns if c != "cell" and r[c]}
    assert got == {(r.cell, r.tag): r.reads for r in tags.collect() if r.reads}
    assert {*wide.columns} - {"cell"} == {r.tag for r in tags.select("tag").distinct().collect()}
    wide = QUERIES["S25_all_samples"](spark, sf)
    part = read(spark, sf, "part").collect()
    assert sum(r[c] for r in wide.collect() for c in wide.columns if c != "gene") == sum(r.p_size for r in part if r.p_brand is not None and r.p_size is not None)
    assert {*wide.columns} - {"gene"} == {r.p_brand for r in part if r.p_brand is not None}


def test_no_labels_or_tags_are_dropped(spark, monkeypatch):
    from tallyloom.plans import q_calls

    df = spark.range(20).select((F.col("id") % 5).alias("p"), (F.col("id") % 4).alias("q"))
    assert matrix.matched_accuracy(df, "p", "q", 20) == pytest.approx(0.2)
    with pytest.raises(ValueError):
        matrix.matched_accuracy(df, "p", "q", 19)
    monkeypatch.setattr(q_calls, "_counts", lambda spark, sf: spark.range(1001).select(F.lit("c").alias("cell"), F.col("id").cast("string").alias("tag"), F.col("id").alias("n")))
    with pytest.raises(ValueError):
        q_calls.t01_zero_filled_counts(spark, "/root/testdata/sf0.001")
