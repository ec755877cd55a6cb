"""Queries of the matrix operators (D) and the statistics (E), with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import reads as rd
from ..operators import aggregates as ag, matrix as mx, rollups as ro, stats as st, windows as wi
from ..session import materialize, ship
from .bindings import SQL_CELL_GENE, SQL_MOL, SQL_READS, cell_gene, molecules, reads
from .registry_helpers import book
from .tables import read

QUERIES, SQL, query = book()


def _x(spark, sf):
    """cell, gene, n and a cluster of the cell (the first section of its label, folded to four)."""
    c = cell_gene(spark, sf).select("cell", "gene", F.col("raw_mols").alias("n"))
    # Written once, since the operators read it several times.
    return materialize(c.withColumn("cluster", (F.split_part("cell", F.lit("-"), F.lit(1)).cast("int") % 4).cast("int")), "expression")


_X = f"{SQL_CELL_GENE}, x AS (SELECT cell, gene, raw_mols AS n, (split_part(cell, '-', 1)::INTEGER % 4) AS cluster FROM cell_gene)"


@query(f"WITH {_X} SELECT gene, sum(n)::BIGINT AS total FROM x GROUP BY gene HAVING sum(n) > 5 AND gene NOT LIKE 'QT7%'")
def d01_kept_genes(spark, sf):
    return mx.kept_genes(_x(spark, sf), "gene", "n", 5, "QT7")


@query(f"WITH {_X}, t AS (SELECT cell, sum(n)::BIGINT AS t FROM x GROUP BY cell) SELECT cell, gene, round(ln(1 + n * (SELECT median(t) FROM t) / t), 9) AS x FROM x JOIN t USING (cell)")
def d02_normalised(spark, sf):
    return mx.normalised(_x(spark, sf), "cell", "n", "median", "e").select("cell", "gene", F.round("x", 9).alias("x"))


@query(f"WITH {_X} SELECT cell, gene, round(n / sqrt(sum(n * n) OVER (PARTITION BY cell)), 9) AS x FROM x")
def d02_unit_length(spark, sf):
    return mx.unit_length(_x(spark, sf), "cell", "n").select("cell", "gene", F.round("x", 9).alias("x"))


@query("SELECT p_partkey, rank() OVER (PARTITION BY p_brand ORDER BY p_size) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2.0 AS rank_no FROM part")
def d03_average_ranks(spark, sf):
    return mx.average_ranks(read(spark, sf, "part"), ["p_brand"], "p_size").select("p_partkey", F.col("rank_no").cast("double").alias("rank_no"))


@query()
def d04_principal_components(spark, sf):
    return mx.principal_components(read(spark, sf, "embeddings"), "embedding", 5).select("vec_id", "label", "components")


@query()
def d04_explained_variance(spark, sf):
    e = mx.explained_variance(read(spark, sf, "embeddings"), "embedding", 5)
    return spark.createDataFrame([(i + 1, v) for i, v in enumerate(e)], "component int, share double")


@query()
def d04_uncorrelated_components(spark, sf):
    c = mx.principal_components(read(spark, sf, "embeddings"), "embedding", 5).withColumn("rate", F.col("embedding")[0].cast("double"))
    return spark.createDataFrame([(i,) for i in mx.without_correlated(c, "components", 5, "rate")], "component int")


def _in_one(spark, sf):
    """All vectors in one group, which ``on_groups`` and ``split_groups`` bound."""
    return read(spark, sf, "embeddings").withColumn("part", F.lit(0))


@query()
def d05_nonnegative_factors(spark, sf):
    return mx.on_groups(_in_one(spark, sf), "part", "vec_id", "embedding", lambda x: mx.nonnegative_factors(x - x.min(), 3), out="weights array<double>")


@query()
def d05_independent_components(spark, sf):
    return mx.on_groups(_in_one(spark, sf), "part", "vec_id", "embedding", lambda x: mx.independent_components(x, 3), out="components array<double>")


@query()
def d07_k_medoids(spark, sf):
    return mx.on_groups(_in_one(spark, sf), "part", "vec_id", "embedding", lambda x: mx.k_medoids(mx.correlation_distance(x), 8))


@query()
def d07_density_clusters(spark, sf):
    return mx.on_groups(_in_one(spark, sf), "part", "vec_id", "embedding", lambda x: mx.density_clusters(mx.correlation_distance(x), 0.7, 4))


@query()
def d07_hierarchical_clusters(spark, sf):
    return mx.on_groups(_in_one(spark, sf), "part", "vec_id", "embedding", lambda x: mx.cut_tree(mx.correlation_distance(x), 8))


@query()
def d07_affinity_clusters(spark, sf):
    return mx.on_groups(_in_one(spark, sf), "part", "vec_id", "embedding", lambda x: mx.affinity_clusters(mx.correlation_distance(x)))


@query()
def d07_shared_neighbour_clusters(spark, sf):
    return mx.on_groups(_in_one(spark, sf), "part", "vec_id", "embedding", lambda x: mx.shared_neighbour_clusters(mx.correlation_distance(x)))


_WHOLE_MEANS = "m AS (SELECT label, i AS dim, avg(embedding[i]::DOUBLE) AS v FROM embeddings, unnest(range(1, len(embedding) + 1)) t(i) GROUP BY 1, 2)"


def _whole_distances(spark, sf):
    e = read(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("dim", "v"))
    p = mx.pair_distances(e.groupBy("label", "dim").agg(F.avg(F.col("v").cast("double")).alias("v")), "label", "dim", "v")
    return p.select("row_a", "row_b", *[F.round(c, 6).alias(c) for c in ("manhattan", "euclidean_2", "correlation")])


@query(
    f"""WITH {_WHOLE_MEANS} SELECT a.label AS row_a, b.label AS row_b, round(sum(abs(a.v - b.v)), 6) AS manhattan, round(sum((a.v - b.v) * (a.v - b.v)), 6) AS euclidean_2, round(1 - corr(a.v, b.v), 6) AS correlation
FROM m a JOIN m b ON a.dim = b.dim AND a.label < b.label GROUP BY 1, 2"""
)
def d06_whole_distances(spark, sf):
    return _whole_distances(spark, sf)


@query()
def d07_k_means(spark, sf):
    return mx.k_means(read(spark, sf, "embeddings"), "embedding", 8).groupBy("label", "cluster").agg(F.count(F.lit(1)).alias("n"))


_RUNS = """r AS (SELECT c_nationkey AS item, o_orderpriority AS p, year(o_orderdate) * 12 + month(o_orderdate) AS run, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
l AS (SELECT run, item, min_by(p, (-n, p)) AS label FROM r GROUP BY 1, 2)"""


@query(f"WITH {_RUNS} SELECT a.item AS item_a, b.item AS item_b, 1 - count(*) / (SELECT count(DISTINCT run) FROM l)::DOUBLE AS distance FROM l a JOIN l b ON a.run = b.run AND a.label = b.label AND a.item < b.item GROUP BY 1, 2")
def d08_consensus(spark, sf):
    """Nations, clustered anew each month by the priority of most of their orders."""
    o = read(spark, sf, "orders").join(read(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    n = o.groupBy((F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("run"), F.col("c_nationkey").alias("item"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    lab = n.groupBy("run", "item").agg(F.min(F.struct((-F.col("n")).alias("m"), F.col("o_orderpriority").alias("label"))).alias("x")).select("run", "item", "x.label")
    return mx.consensus(lab, "run", "item", "label")


@query()
def d09_dendro_split(spark, sf):
    return mx.split_groups(_in_one(spark, sf), "part", "vec_id", "embedding", 4.0, merge=False)


@query()
def d10_dendro_merge(spark, sf):
    return mx.split_groups(_in_one(spark, sf), "part", "vec_id", "embedding", 4.0)


_OUTLIERS = 0.5


@query(
    f"""WITH {_WHOLE_MEANS}, d AS (SELECT a.label AS row_no, b.label AS other, round(1 - corr(a.v, b.v), 6) AS distance FROM m a JOIN m b ON a.dim = b.dim AND a.label <> b.label GROUP BY 1, 2),
n AS (SELECT row_no, min_by(other, (distance, other)) AS label, min(distance) AS distance FROM d GROUP BY 1)
SELECT row_no, CASE WHEN distance <= (SELECT quantile_cont(distance, {_OUTLIERS}) FROM n) THEN label END AS label, distance FROM n"""
)
def d11_whole_nearest_label(spark, sf):
    """By correlation distance over all dimensions, none beyond the median of nearest distances."""
    p = _whole_distances(spark, sf)
    side = lambda a, b: p.select(F.col(f"row_{a}").alias("row_no"), F.col(f"row_{b}").alias("other"), F.col(f"row_{b}").alias("label"), F.col("correlation").alias("distance"))
    return mx.nearest_label(side("a", "b").union(side("b", "a")), "row_no", "other", "label", "distance", _OUTLIERS)


_W = f"""{_X}, s AS (SELECT count(DISTINCT cell) FILTER (cluster = 0) AS na, count(DISTINCT cell) FILTER (cluster = 1) AS nb FROM x),
w AS (SELECT gene, sum(CASE WHEN cluster = 0 THEN n ELSE 0 END)::DOUBLE AS sa, sum(CASE WHEN cluster = 0 THEN n * n ELSE 0 END)::DOUBLE AS qa, sum(CASE WHEN cluster = 1 THEN n ELSE 0 END)::DOUBLE AS sb, sum(CASE WHEN cluster = 1 THEN n * n ELSE 0 END)::DOUBLE AS qb FROM x WHERE cluster < 2 GROUP BY gene),
v AS (SELECT *, (qa - sa * sa / na) / (na - 1) / na AS va, (qb - sb * sb / nb) / (nb - 1) / nb AS vb FROM w, s)"""


def _welch(spark, sf):
    x = _x(spark, sf).filter("cluster < 2")
    sizes = {r[0]: r[1] for r in x.groupBy("cluster").agg(F.count_distinct("cell").alias("n")).orderBy("cluster").collect()}
    return mx.welch(x, "gene", "cluster", "n", {k: sizes[k] for k in (0, 1)})


@query(f"WITH {_W} SELECT gene, round(sa / na, 9) AS mean_a, round(sb / nb, 9) AS mean_b, round((sa / na - sb / nb) / nullif(sqrt(va + vb), 0), 6) AS t, round((va + vb) * (va + vb) / nullif(va * va / (na - 1) + vb * vb / (nb - 1), 0), 4) AS df FROM v")
def d12_welch(spark, sf):
    w = _welch(spark, sf)
    return w.select("gene", F.round("mean_a", 9).alias("mean_a"), F.round("mean_b", 9).alias("mean_b"), F.round("t", 6).alias("t"), F.round("df", 4).alias("df"))


@query()
def d12_ranked_genes(spark, sf):
    return mx.ranked_by_welch(_welch(spark, sf))


@query()
def d13_forest_ranking(spark, sf):
    li = read(spark, sf, "lineitem").withColumn("y", (F.col("l_returnflag") == "N").cast("double"))
    return mx.ranked_features(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "y")


@query()
def d13_sparse_ranking(spark, sf):
    li = read(spark, sf, "lineitem").withColumn("y", (F.col("l_returnflag") == "N").cast("double"))
    return mx.ranked_features(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "y", "lasso")


_THRESHOLDS = [float(t) for t in range(10, 120, 5)]


@query()
def d14_threshold_sweep(spark, sf):
    """Numbers of clusters over split thresholds, and the threshold where they stay longest."""
    sweep = mx.split_sweep(_in_one(spark, sf), "part", "vec_id", "embedding", _THRESHOLDS)
    scores = sorted((r.threshold, r.clusters) for r in sweep.collect())
    best = mx.plateau(scores)
    return spark.createDataFrame([(t, n, t == best) for t, n in scores], "threshold double, clusters int, chosen boolean")


_NMI = """c AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*)::DOUBLE AS n FROM orders GROUP BY 1, 2), p AS (SELECT n / sum(n) OVER () AS p, sum(n) OVER (PARTITION BY a) / sum(n) OVER () AS pa, sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS pb FROM c)"""


@query(f"WITH {_NMI} SELECT round(sum(p * ln(p / (pa * pb))) / sqrt(sum(-p * ln(pa)) * sum(-p * ln(pb))), 9) AS nmi FROM p")
def d15_mutual_information(spark, sf):
    return mx.nmi(read(spark, sf, "orders"), "o_orderstatus", "o_orderpriority").select(F.round("nmi", 9).alias("nmi"))


@query(
    """WITH n AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT (SELECT max(x.n + y.n + z.n) FROM n x, n y, n z WHERE x.a < y.a AND y.a < z.a AND x.b <> y.b AND x.b <> z.b AND y.b <> z.b) / (SELECT count(*)::DOUBLE FROM orders) AS accuracy"""
)
def d15_matched_accuracy(spark, sf):
    return spark.createDataFrame([(mx.matched_accuracy(read(spark, sf, "orders"), "o_orderstatus", "o_orderpriority"),)], "accuracy double")


@query(f"WITH {SQL_READS}, g AS (SELECT library AS cell, split_part(split_part(target, '|', 1), ':', 1) || CASE WHEN target LIKE '%pAbO' THEN '{rd.PROTEIN_MARK}' ELSE '' END AS gene, sum(position)::BIGINT AS n FROM reads GROUP BY 1, 2) SELECT cell, gene, round(log10(1 + n * 10000.0 / nullif(sum(n) OVER (PARTITION BY cell), 0)), 9) AS x FROM g")
def d16_classifier_profile(spark, sf):
    return mx.counts_to_profile(reads(spark, sf), "library", rd.plain_gene_name(F.col("target")), "position").select(F.col("library").alias("cell"), "gene", F.round("x", 9).alias("x"))


@query(f"WITH {_X}, t AS (SELECT cell, sum(n)::BIGINT AS t FROM x GROUP BY cell) SELECT cell, gene, round(ln(1 + n * 10000.0 / t), 9) AS x FROM x JOIN t USING (cell)")
def d17_log_normalised(spark, sf):
    return mx.normalised(_x(spark, sf), "cell", "n", 10_000.0, "e").select("cell", "gene", F.round("x", 9).alias("x"))


_SW = "sw AS (SELECT year(o_orderdate) AS run, o_orderstatus AS a, CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority ELSE o_orderstatus END AS b FROM orders), n AS (SELECT run, a, b, count(*) AS n FROM sw GROUP BY 1, 2, 3), j AS (SELECT run, a, max(n / (sa + sb - n)) AS j FROM (SELECT *, sum(n) OVER (PARTITION BY run, a)::DOUBLE AS sa, sum(n) OVER (PARTITION BY run, b)::DOUBLE AS sb FROM n) GROUP BY 1, 2)"


@query(f"WITH {_SW} SELECT a, round(avg(j), 9) AS mean_jaccard, avg((j >= 0.6)::INT) >= 0.8 AS is_stable FROM j GROUP BY a")
def d18_stability(spark, sf):
    o = read(spark, sf, "orders").select(F.year("o_orderdate").alias("run"), F.col("o_orderstatus").alias("a"), F.when(F.col("o_orderkey") % 7 == 0, F.col("o_orderpriority")).otherwise(F.col("o_orderstatus")).alias("b"), "o_orderkey")
    return mx.stability(o, "run", "a", "b", "o_orderkey").select("a", F.round("mean_jaccard", 9).alias("mean_jaccard"), "is_stable")


@query("SELECT label, median(embedding[1]::DOUBLE) AS x, median(embedding[2]::DOUBLE) AS y FROM embeddings GROUP BY label")
def d19_graph_positions(spark, sf):
    return read(spark, sf, "embeddings").groupBy("label").agg(F.median(F.col("embedding")[0].cast("double")).alias("x"), F.median(F.col("embedding")[1].cast("double")).alias("y"))


@query("SELECT source, count(*) AS texts FROM (SELECT DISTINCT source, text FROM documents) GROUP BY source")
def d20_distinct_per_sample(spark, sf):
    return read(spark, sf, "documents").select("source", F.sha2("text", 256).alias("t")).distinct().groupBy("source").agg(F.count(F.lit(1)).alias("texts"))


# ---------------------------------------------------------------- statistics


def _sizes(x):
    return x.groupBy("cluster").agg(F.count_distinct("cell").alias("n_cells"))


_SZ = "sz AS (SELECT cluster, count(DISTINCT cell) AS n_cells FROM x GROUP BY cluster), i AS (SELECT cluster, gene, count(*) AS k, sum(n)::BIGINT AS s, sum(n * n)::DOUBLE AS q FROM x WHERE n > 0 GROUP BY 1, 2), tot AS (SELECT sum(n_cells) AS n_all FROM sz)"


@query(
    f"""WITH {_X}, {_SZ} SELECT cluster, gene, k / n_cells AS pct_in, (sum(k) OVER g - k) / (n_all - n_cells) AS pct_out, s / n_cells AS mean_in, (sum(s) OVER g - s) / (n_all - n_cells) AS mean_out,
  round(log2((s / n_cells + 1e-9) / ((sum(s) OVER g - s) / (n_all - n_cells) + 1e-9)), 6) AS log2_fc FROM i JOIN sz USING (cluster), tot WINDOW g AS (PARTITION BY gene)"""
)
def e01_marker_shares(spark, sf):
    x = _x(spark, sf)
    return st.expression_shares(x, "cluster", "cell", "gene", "n", _sizes(x)).withColumn("log2_fc", F.round("log2_fc", 6))


@query(
    """WITH r AS (SELECT p_brand AS gene, p_size, p_partkey % 3 = 0 AS g, rank() OVER (PARTITION BY p_brand ORDER BY p_size) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2.0 AS r, count(*) OVER (PARTITION BY p_brand, p_size) AS t, count(*) OVER (PARTITION BY p_brand)::DOUBLE AS n FROM part),
s AS (SELECT gene, sum(CASE WHEN g THEN r ELSE 0 END) AS r1, count(*) FILTER (g)::DOUBLE AS n1, any_value(n) AS n, sum(t * t - 1)::DOUBLE AS ties FROM r GROUP BY gene)
SELECT gene, round((r1 - n1 * (n1 + 1) / 2)::DOUBLE, 6) AS u, round((r1 - n1 * (n1 + 1) / 2 - n1 * (n - n1) / 2) / nullif(sqrt(n1 * (n - n1) / 12 * (n + 1 - ties / nullif(n * (n - 1), 0))), 0), 6) AS z FROM s"""
)
def e01_rank_sum(spark, sf):
    p = read(spark, sf, "part").select(F.col("p_brand").alias("gene"), "p_size", (F.col("p_partkey") % 3 == 0).alias("g"))
    return st.rank_sum(p, "gene", "g", "p_size").select("gene", F.round(F.col("u").cast("double"), 6).alias("u"), F.round("z", 6).alias("z"))


@query(f"WITH {_X}, {_SZ}, c AS (SELECT cluster, gene, s / sqrt(sum(q) OVER (PARTITION BY gene) * n_cells) AS cosine FROM i JOIN sz USING (cluster)) SELECT cluster, gene, round(cosine, 9) AS cosine, round(cosine * cosine / sum(cosine * cosine) OVER (PARTITION BY gene), 9) AS share FROM c")
def e02_cosine_markers(spark, sf):
    x = _x(spark, sf)
    return st.cosine_scores(x.filter("n > 0"), "cluster", "gene", "n", _sizes(x)).select("cluster", "gene", F.round("cosine", 9).alias("cosine"), F.round("share", 9).alias("share"))


@query(f"WITH {_X}, {_SZ}, e AS (SELECT cluster, gene, s / n_cells AS mean_in, (sum(s) OVER g - s) / (n_all - n_cells) AS mean_out FROM i JOIN sz USING (cluster), tot WINDOW g AS (PARTITION BY gene)) SELECT cluster, gene FROM e WHERE abs(log2((mean_in + 1e-9) / (mean_out + 1e-9))) > 1 AND mean_in > 0.01")
def e03_significant_genes(spark, sf):
    x = _x(spark, sf)
    return st.expression_shares(x, "cluster", "cell", "gene", "n", _sizes(x)).filter((F.abs("log2_fc") > 1) & (F.col("mean_in") > 0.01)).select("cluster", "gene")


def _parts(spark, sf):
    p = read(spark, sf, "part").withColumn("gene", F.col("p_partkey"))
    return p.filter("p_size > 40").select("gene"), p.select(F.col("p_brand").alias("set_id"), "gene"), p.select("gene")


@query("SELECT p_brand AS set_id, count(*) FILTER (p_size > 40) AS k, count(*) AS k_set, (SELECT count(*) FROM part WHERE p_size > 40) AS n, (SELECT count(*) FROM part) AS n_all FROM part GROUP BY 1")
def e04_overlap_counts(spark, sf):
    q, s, b = _parts(spark, sf)
    c = st.overlap_counts(q, s, "set_id", "gene", b)
    return c.toDF("set_id", "k", "k_set", "n", "n_all")


@query(
    """WITH c AS (SELECT p_brand AS set_id, count(*) FILTER (p_size > 40) AS k, count(*) AS k_set, (SELECT count(*) FROM part WHERE p_size > 40) AS n, (SELECT count(*) FROM part) AS n_all FROM part GROUP BY 1),
t AS (SELECT *, unnest(range(k, least(n, k_set) + 1)) AS i FROM c WHERE k > 0),
h AS (SELECT set_id, k, k_set, n, n_all, least(1.0, sum(CASE WHEN n - i <= n_all - k_set THEN exp(lgamma(k_set + 1) - lgamma(i + 1) - lgamma(k_set - i + 1) + lgamma(n_all - k_set + 1) - lgamma(n - i + 1)
  - lgamma(n_all - k_set - n + i + 1) - lgamma(n_all + 1) + lgamma(n + 1) + lgamma(n_all - n + 1)) ELSE 0 END)) AS p FROM t GROUP BY 1, 2, 3, 4, 5),
r AS (SELECT *, p * count(*) OVER () / (rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1) AS raw FROM h)
SELECT set_id, k, k_set, n, n_all, round(p, 7) AS p, round((k / n) / (k_set / n_all), 9) AS fold, round(least(1.0, min(raw) OVER (ORDER BY p DESC)), 7) AS q FROM r"""
)
def e04_enrichment(spark, sf):
    q, s, b = _parts(spark, sf)
    return st.enrichment(q, s, "set_id", "gene", b).toDF("set_id", "k", "k_set", "n", "n_all", "p", "fold", "q").withColumns({"p": F.round("p", 7), "fold": F.round("fold", 9), "q": F.round("q", 7)})


@query(
    """WITH r AS (SELECT p_partkey AS gene, p_retailprice - 1300 AS s, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS pos, count(*) OVER () AS n FROM part),
w AS (SELECT b.p_brand AS set_id, r.pos, CASE WHEN m.p_brand = b.p_brand THEN abs(s) ELSE 0 END AS a, CASE WHEN m.p_brand = b.p_brand THEN 0 ELSE 1 END AS miss FROM (SELECT DISTINCT p_brand FROM part) b, r JOIN part m ON m.p_partkey = r.gene),
c AS (SELECT set_id, sum(a) OVER (PARTITION BY set_id ORDER BY pos) / sum(a) OVER (PARTITION BY set_id) - sum(miss) OVER (PARTITION BY set_id ORDER BY pos) / sum(miss) OVER (PARTITION BY set_id) AS e FROM w)
SELECT set_id, (SELECT count(*) FROM part WHERE p_brand = set_id) AS size, round(CASE WHEN max(e) >= -min(e) THEN max(e) ELSE min(e) END, 6) AS score FROM c GROUP BY set_id"""
)
def e05_running_enrichment(spark, sf):
    p = read(spark, sf, "part").select(F.col("p_partkey").alias("gene"), F.col("p_brand").alias("set_id"), (F.col("p_retailprice") - 1300).alias("s"))
    return st.running_enrichment(p, p, "set_id", "gene", "s").withColumn("score", F.round("score", 6))


@query("SELECT max(s) AS set_id, any_value(len(g))::INTEGER AS size FROM (SELECT sequence_id AS s, list(DISTINCT gene ORDER BY gene) AS g FROM pyir_hits WHERE sequence_id IS NOT NULL AND gene IS NOT NULL GROUP BY 1) GROUP BY g")
def e06_distinct_sets(spark, sf):
    return st.distinct_sets(read(spark, sf, "pyir_hits").withColumnRenamed("sequence_id", "set_id"), "set_id", "gene")


_DAG = "e AS (SELECT 'n' || n_nationkey AS child, 'r' || n_regionkey AS parent FROM nation UNION SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier UNION SELECT 'r' || r_regionkey, 'root' FROM region UNION SELECT 's' || s_suppkey, 'r0' FROM supplier WHERE s_acctbal > 0)"


@query(f"WITH RECURSIVE {_DAG}, a AS (SELECT child, parent AS ancestor, 1 AS steps FROM e UNION SELECT a.child, e.parent, steps + 1 FROM a JOIN e ON a.ancestor = e.child) SELECT child, ancestor, min(steps)::INTEGER AS steps FROM a GROUP BY 1, 2")
def e07_ancestors(spark, sf):
    n, s, r = (read(spark, sf, t) for t in ("nation", "supplier", "region"))
    k = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    e = n.select(k("n", "n_nationkey").alias("child"), k("r", "n_regionkey").alias("parent"))
    e = e.union(s.select(k("s", "s_suppkey"), k("n", "s_nationkey"))).union(r.select(k("r", "r_regionkey"), F.lit("root"))).union(s.filter("s_acctbal > 0").select(k("s", "s_suppkey"), F.lit("r0")))
    return st.ancestors(e)


@query(f"WITH {_X} SELECT substr(gene, 1, 4) AS set_id, cell, sum(n)::BIGINT AS activity FROM x GROUP BY 1, 2")
def e08_set_activity(spark, sf):
    x = _x(spark, sf)
    return st.set_activity(x, x.select(F.substring("gene", 1, 4).alias("set_id"), "gene"), "set_id", "cell", "gene", "n")


@query()
def e09_module_score(spark, sf):
    x = _x(spark, sf)
    return st.module_score(x, x.filter(F.startswith("gene", F.lit("QT1"))).select("gene"), "cell", "gene", "n", x.select("cell").distinct().count())


@query()
def e10_factor_enrichment(spark, sf):
    p = read(spark, sf, "part").withColumn("gene", F.col("p_partkey"))
    s = p.select(F.col("p_type").alias("set_id"), "gene")
    big = s.groupBy("set_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 50").select("set_id")
    return st.enrichment(p.filter("p_size > 40").select("gene"), s.join(big, "set_id", "left_semi"), "set_id", "gene", p.select("gene")).toDF("set_id", "k", "k_set", "n", "n_all", "p", "fold", "q")


@query("SELECT trim(gene) AS gene, coalesce(string_agg(DISTINCT gene_type, '|' ORDER BY gene_type) FILTER (trim(gene_type) <> ''), '-') AS types, count(*) AS n FROM pyir_hits WHERE trim(gene) <> '' GROUP BY 1")
def e11_annotation_rollup(spark, sf):
    h = read(spark, sf, "pyir_hits").withColumn("gene", F.trim("gene")).filter("gene != ''")
    return h.groupBy("gene").agg(ag.unique_text("gene_type").alias("types"), F.count(F.lit(1)).alias("n"))


_Q = "q AS (SELECT sequence_id, gene, e_value AS p, least(1.0, min(e_value * n / r) OVER (ORDER BY e_value DESC RANGE UNBOUNDED PRECEDING)) AS q FROM (SELECT *, count(*) OVER () AS n, rank() OVER (ORDER BY e_value) + count(*) OVER (PARTITION BY e_value) - 1 AS r FROM (SELECT DISTINCT sequence_id, gene, e_value FROM pyir_hits WHERE e_value <= 1 AND sequence_id IS NOT NULL AND gene IS NOT NULL)))"


@query(f"WITH {_Q} SELECT CASE WHEN q < 1e-6 THEN 'strict' WHEN q < 1e-3 THEN 'loose' ELSE 'none' END AS mask, count(*) AS n FROM q GROUP BY 1")
def e12_fdr_masks(spark, sf):
    p = read(spark, sf, "pyir_hits").filter("e_value <= 1").select("sequence_id", "gene", F.col("e_value").alias("p")).dropna().distinct()
    q = wi.adjust_p(p, "p")
    return q.groupBy(F.when(F.col("q") < 1e-6, "strict").when(F.col("q") < 1e-3, "loose").otherwise("none").alias("mask")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {_X}, v AS (SELECT cell, sum(n)::DOUBLE AS v, count(*) OVER () AS n_cells FROM x GROUP BY cell), s AS (SELECT gene, sum(n * v) AS xy, sum(n)::DOUBLE AS sx, sum(n * n)::DOUBLE AS qx FROM x JOIN v USING (cell) GROUP BY gene), t AS (SELECT sum(v) AS sv, sum(v * v) AS qv, any_value(n_cells) AS c FROM v)
SELECT gene, round((c * xy - sx * sv) / nullif(sqrt((c * qx - sx * sx) * (c * qv - sv * sv)), 0), 6) AS r FROM s, t"""
)
def e13_gene_correlations(spark, sf):
    x = _x(spark, sf)
    v = x.groupBy("cell").agg(F.sum("n").alias("v"))
    return st.correlations(x, "gene", "cell", "n", v, "v", v.count()).withColumn("r", F.round("r", 6))


_CG = f"{_X}, cg AS (SELECT cluster, gene, sum(n)::DOUBLE AS v FROM x GROUP BY 1, 2)"


def _by_cluster(spark, sf):
    return _x(spark, sf).groupBy("cluster", "gene").agg(F.sum("n").cast("double").alias("v"))


@query(f"WITH {_CG} SELECT a.cluster AS sample_a, b.cluster AS sample_b, round(corr(a.v, b.v), 6) AS r FROM cg a JOIN cg b ON a.gene = b.gene AND a.cluster <= b.cluster GROUP BY 1, 2")
def e14_pearson(spark, sf):
    return st.sample_correlations(_by_cluster(spark, sf), "cluster", "gene", "v").withColumn("r", F.round("r", 6))


@query(f"WITH {_CG}, rk AS (SELECT cluster, gene, rank() OVER (PARTITION BY cluster ORDER BY v) + (count(*) OVER (PARTITION BY cluster, v) - 1) / 2.0 AS v FROM cg) SELECT a.cluster AS sample_a, b.cluster AS sample_b, round(corr(a.v, b.v), 6) AS r FROM rk a JOIN rk b ON a.gene = b.gene AND a.cluster <= b.cluster GROUP BY 1, 2")
def e14_spearman(spark, sf):
    return st.sample_correlations(_by_cluster(spark, sf), "cluster", "gene", "v", "spearman").withColumn("r", F.round("r", 6))


@query(
    f"""WITH {_CG}, p AS (SELECT a.cluster AS sample_a, b.cluster AS sample_b, a.gene, a.v AS va, b.v AS vb FROM cg a JOIN cg b ON a.gene = b.gene AND a.cluster < b.cluster),
q AS (SELECT x.sample_a, x.sample_b, sum(sign(x.va - y.va) * sign(x.vb - y.vb))::DOUBLE AS s, count(*) FILTER (x.va <> y.va)::DOUBLE AS na, count(*) FILTER (x.vb <> y.vb)::DOUBLE AS nb
  FROM p x JOIN p y ON x.sample_a = y.sample_a AND x.sample_b = y.sample_b AND x.gene < y.gene GROUP BY 1, 2)
SELECT sample_a, sample_b, round(s / sqrt(na * nb), 9) AS tau FROM q"""
)
def e14_kendall(spark, sf):
    """Between clusters, over all genes that both have: one group per pair of the four clusters."""
    ship(spark)
    y = _by_cluster(spark, sf)
    p = y.withColumnsRenamed({"cluster": "sample_a", "v": "va"}).join(y.withColumnsRenamed({"cluster": "sample_b", "v": "vb"}), "gene").filter("sample_a < sample_b")

    def run(g):
        import pandas as pd

        return pd.DataFrame({"sample_a": [g["sample_a"].iloc[0]], "sample_b": [g["sample_b"].iloc[0]], "tau": [round(st.kendall([*g["va"]], [*g["vb"]]), 9)]})

    return p.groupBy("sample_a", "sample_b").applyInPandas(run, "sample_a int, sample_b int, tau double")


@query()
def e15_bootstrap_shares(spark, sf):
    n = read(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return st.bootstrap_shares(n, "o_orderstatus", "o_orderpriority", "n")


@query(f"WITH {_CG} SELECT gene, avg(v) AS mean, stddev_samp(v) / sqrt(count(v)) AS se FROM cg GROUP BY gene".replace("stddev_samp(v) / sqrt(count(v))", "round(stddev_samp(v) / sqrt(count(v)), 9)"))
def e17_signature(spark, sf):
    return st.summary_with_error(_by_cluster(spark, sf), ["gene"], "v").select("gene", "mean", F.round("se", 9).alias("se"))


@query("SELECT user_id, event_id, round((value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0), 6) AS z, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INTEGER AS step FROM events WINDOW w AS (PARTITION BY user_id)")
def e18_scaled_series(spark, sf):
    from pyspark.sql import Window

    e = wi.scaled(read(spark, sf, "events"), ["user_id"], "value")
    return e.select("user_id", "event_id", F.round("z", 6).alias("z"), F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("step"))


@query(
    """WITH s AS (SELECT l_quantity AS v, sum(CASE WHEN l_returnflag = 'A' THEN l_linenumber ELSE 0 END)::DOUBLE AS a, sum(CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END)::DOUBLE AS b FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1)
SELECT round(max(abs(d)), 9) AS ks FROM (SELECT sum(a) OVER (ORDER BY v) / sum(a) OVER () - sum(b) OVER (ORDER BY v) / sum(b) OVER () AS d FROM s)"""
)
def e19_weighted_ks(spark, sf):
    return st.weighted_ks(read(spark, sf, "lineitem"), "l_returnflag", "l_quantity", "l_linenumber", "A", "R").select(F.round("ks", 9).alias("ks"))


@query(f"WITH {SQL_MOL}, g AS (SELECT gene FROM mol GROUP BY gene HAVING count(DISTINCT cell) > 10), c AS (SELECT cell, count(*) AS n, count(DISTINCT gene) AS f, 100.0 * count(*) FILTER (gene LIKE 'QT7%') / count(*) AS pct FROM mol SEMI JOIN g USING (gene) GROUP BY cell) SELECT cell, n, f, pct FROM c WHERE log10(f) / nullif(log10(n), 0) > 0.8 AND pct < 20")
def e20_qc_gates(spark, sf):
    m = molecules(spark, sf)
    g = m.groupBy("gene").agg(F.count_distinct("cell").alias("k")).filter("k > 10").select("gene")
    c = m.join(g, "gene", "left_semi").groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("gene").alias("f"), ag.percent(F.count_if(F.startswith("gene", F.lit("QT7"))), F.count(F.lit(1))).alias("pct"))
    c = c.withColumn("rate", F.try_divide(F.log10("f"), F.nullif(F.log10("n"), F.lit(0.0))))
    return c.filter(st.within_gates(c, {"rate": (0.8, None), "pct": (None, 20.0)})).select("cell", "n", "f", "pct")


@query("SELECT sample, metric, value FROM (SELECT o_orderstatus AS sample, count(*)::DOUBLE AS orders, max(o_totalprice) AS top FROM orders GROUP BY 1) UNPIVOT (value FOR metric IN (orders, top))")
def e22_stacked_metrics(spark, sf):
    m = read(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("sample")).agg(F.count(F.lit(1)).cast("double").alias("orders"), F.max("o_totalprice").alias("top"))
    return ro.stacked_metrics(m, "sample", ["orders", "top"])


@query(f"WITH {_CG} SELECT cluster, gene, v FROM cg WHERE gene LIKE 'QT3%'")
def e23_target_gene_query(spark, sf):
    return _by_cluster(spark, sf).filter(F.startswith("gene", F.lit("QT3")))


@query(f"WITH {SQL_MOL} SELECT mol_id, cell AS CB, coalesce(CASE WHEN length(corrected_umi) >= 8 THEN corrected_umi END, umi) AS UB FROM mol WHERE rsec_reads > 0")
def e24_velocity_input(spark, sf):
    return ro.velocity_input(molecules(spark, sf)).select("mol_id", "CB", "UB")


@query(f"WITH {_CG}, l AS (SELECT cluster, gene, log2((v + 1) / (avg(v) OVER (PARTITION BY gene) + 1)) AS lfc FROM cg) SELECT cluster, gene, round(lfc, 6) AS lfc, abs(lfc) > 1 AS is_outlier, split_part(gene, 'G', 1) AS block FROM l")
def e25_heatmap_input(spark, sf):
    x = ro.heatmap_input(_by_cluster(spark, sf), "cluster", "gene", "v")
    return x.select("cluster", "gene", F.round("lfc", 6).alias("lfc"), "is_outlier", F.split_part("gene", F.lit("G"), F.lit(1)).alias("block"))
