"""Queries of the aggregations (A), windows (W) and set operators (O), with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import label_to_index
from ..functions.text import sql_digest_number
from ..operators import aggregates as ag, joins, rollups as ro, sets, windows as wi
from ..operators.wide import attributes_of, unpivot
from ..session import materialize
from .bindings import SQL_CALLED, SQL_CELL_GENE, SQL_MOL, SQL_READS, SQL_TAGS, called_cells, cell_gene, molecules, reads, tag_counts
from .registry_helpers import book
from .tables import read

QUERIES, SQL, query = book()

_OK = "status IN ('1', 'MAcorrected')"


def _flags():
    s = F.col("status")
    return {"mapped": s.isin("1", "MAcorrected"), "ambiguous": F.startswith(s, F.lit("ambiguous")), "control": F.col("is_control")}


_LIB = f"""lib AS (SELECT CASE WHEN grouping(library) = 1 THEN 'All' ELSE library END AS library, count(*) AS reads, count(*) FILTER ({_OK}) AS mapped,
  count(*) FILTER (status LIKE 'ambiguous%') AS ambiguous, count(*) FILTER (is_control) AS control FROM reads GROUP BY GROUPING SETS ((library), ()))"""


@query(f"WITH {SQL_READS}, {_LIB} SELECT *, 100.0 * mapped / reads AS pct_mapped, 100.0 * ambiguous / reads AS pct_ambiguous, 100.0 * control / reads AS pct_control FROM lib")
def a01_library_metrics(spark, sf):
    return ag.library_metrics(reads(spark, sf), "library", _flags())


@query(
    f"""WITH {SQL_READS}, m AS (SELECT library, count(*) AS reads, count(*) FILTER ({_OK}) AS mapped FROM reads GROUP BY library)
SELECT CASE WHEN grouping(library) = 1 THEN 'Combined' ELSE library END AS library, sum(reads)::BIGINT AS reads, sum(mapped)::BIGINT AS mapped, 100.0 * sum(mapped) / sum(reads) AS pct_mapped FROM m GROUP BY GROUPING SETS ((library), ())"""
)
def a02_combine_libraries(spark, sf):
    m = reads(spark, sf).groupBy("library").agg(F.count(F.lit(1)).alias("reads"), F.count_if(F.col("status").isin("1", "MAcorrected")).alias("mapped"))
    return ag.combine_libraries(m, "library", "reads", ["mapped"])


@query("SELECT l_returnflag, sum(l_quantity * l_linenumber) / sum(l_linenumber) AS mean_quantity FROM lineitem GROUP BY 1")
def a03_weighted_quality(spark, sf):
    return read(spark, sf, "lineitem").groupBy("l_returnflag").agg(ag.weighted_mean("l_quantity", "l_linenumber").alias("mean_quantity"))


@query(f"WITH {SQL_TAGS} SELECT tag, sum(reads)::BIGINT AS reads, 100.0 * sum(reads) / sum(sum(reads)) OVER () AS pct FROM tags GROUP BY tag")
def a04_reads_per_tag(spark, sf):
    return ag.count_and_share(tag_counts(spark, sf), "tag", F.col("reads"), "reads")


_MM = ", ".join(f"count(nullif({c}, 0)) AS {c}_molecules, sum(nullif({c}, 0))::BIGINT AS {c}_reads, median(nullif({c}, 0)) AS {c}_median, avg(nullif({c}, 0)) AS {c}_mean, count(*) FILTER ({c} = 1) AS {c}_singletons" for c in ("raw_reads", "rsec_reads", "dbec_reads"))


@query(f"WITH {SQL_MOL}, k AS (SELECT *, CASE WHEN gene LIKE 'QT1%' THEN 'protein' ELSE 'mrna' END AS kind FROM mol) SELECT CASE WHEN grouping(kind) = 1 THEN 'Combined' ELSE kind END AS kind, {_MM} FROM k GROUP BY GROUPING SETS ((kind), ())")
def a05_molecule_metrics(spark, sf):
    m = molecules(spark, sf).withColumn("kind", F.when(F.startswith("gene", F.lit("QT1")), "protein").otherwise("mrna"))
    return ag.molecule_metrics(m, "kind", ["raw_reads", "rsec_reads", "dbec_reads"])


def _indexed(spark, sf):
    """Cell-gene counts with the cell's index and the gene's kind."""
    kind = F.when(F.startswith("gene", F.lit("QT1")), "protein").otherwise("mrna")
    return cell_gene(spark, sf).withColumn("cell", label_to_index(F.col("cell")).cast("int")).withColumn("kind", kind)


_IDX = f"""{SQL_CELL_GENE}, idx AS (SELECT * REPLACE (((split_part(cell, '-', 1)::BIGINT - 1) * 9216 + (split_part(cell, '-', 2)::BIGINT - 1) * 96 + split_part(cell, '-', 3)::BIGINT)::INTEGER AS cell),
  CASE WHEN gene LIKE 'QT1%' THEN 'protein' ELSE 'mrna' END AS kind FROM cell_gene)"""
_CALLED2 = f"{_IDX}, {SQL_CALLED}"


@query(
    f"""WITH {_CALLED2}, top AS (SELECT cell FROM idx GROUP BY cell HAVING count(*) > 5 UNION SELECT cell FROM called), p AS (SELECT cell, kind, sum(rsec_mols)::BIGINT AS total, count(*) AS n_genes FROM idx GROUP BY 1, 2),
d AS (SELECT t.cell, k.kind, coalesce(p.total, 0) AS total, coalesce(p.n_genes, 0) AS n_genes FROM top t CROSS JOIN (SELECT unnest(['mrna', 'protein']) AS kind) k LEFT JOIN p ON p.cell = t.cell AND p.kind = k.kind)
SELECT kind, min(total) AS min_total, max(total) AS max_total, avg(total) AS mean_total, median(total) AS median_total, sum(total)::BIGINT AS sum_total,
  min(n_genes) AS min_n_genes, max(n_genes) AS max_n_genes, avg(n_genes) AS mean_n_genes, median(n_genes) AS median_n_genes, sum(n_genes)::BIGINT AS sum_n_genes FROM d GROUP BY kind"""
)
def a06_cell_metrics(spark, sf):
    x = materialize(_indexed(spark, sf), "cell-genes")
    top = x.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 5").select("cell").union(called_cells(spark, sf).select("cell")).distinct()
    return ag.cell_metrics(x, top, "cell", "kind", ["mrna", "protein"], "rsec_mols")


@query(
    f"""WITH {_CALLED2} SELECT CASE WHEN grouping(kind) = 1 THEN 'All' ELSE kind END AS kind, count(DISTINCT gene) AS genes, 100.0 * sum(CASE WHEN called.cell IS NOT NULL THEN reads END) / sum(reads) AS pct_reads,
  100.0 * sum(CASE WHEN called.cell IS NOT NULL THEN raw_mols END) / sum(raw_mols) AS pct_mols FROM idx LEFT JOIN called ON idx.cell = called.cell GROUP BY GROUPING SETS ((kind), ())"""
)
def a07_genes_and_share_in_cells(spark, sf):
    x = joins.lookup(_indexed(spark, sf), called_cells(spark, sf).select("cell", F.lit(True).alias("by")), ["cell"])
    inside = lambda c: F.sum(F.when(F.col("by").isNotNull(), F.col(c)))
    return ag.with_total(x, "kind", [F.count_distinct("gene").alias("genes"), ag.percent(inside("reads"), F.sum("reads")).alias("pct_reads"), ag.percent(inside("raw_mols"), F.sum("raw_mols")).alias("pct_mols")])


@query(f"WITH {SQL_TAGS}, {SQL_CALLED} SELECT tag, 100.0 * sum(CASE WHEN called.cell IS NOT NULL THEN reads ELSE 0 END) / nullif(sum(reads), 0) AS pct FROM tags LEFT JOIN called USING (cell) GROUP BY tag")
def a08_tag_share_in_cells(spark, sf):
    x = joins.lookup(tag_counts(spark, sf), called_cells(spark, sf).select("cell", F.lit(True).alias("by")), ["cell"])
    return x.groupBy("tag").agg(ag.percent(F.sum(F.when(F.col("by"), F.col("reads")).otherwise(0)), F.sum("reads")).alias("pct"))


@query(
    f"""WITH {SQL_CELL_GENE} SELECT 100.0 * sum(CASE WHEN gene LIKE 'QT2%' THEN reads END) / sum(reads) AS pct_listed, 100.0 * count(DISTINCT CASE WHEN gene LIKE 'QT3%' THEN cell END) / count(DISTINCT cell) AS pct_cells_expressing,
  1.0 * sum(CASE WHEN gene NOT LIKE 'QT2%' THEN rsec_mols END) / count(DISTINCT CASE WHEN gene NOT LIKE 'QT2%' THEN cell END) AS mean_mols_without FROM cell_gene"""
)
def a09_bias_metrics(spark, sf):
    x = cell_gene(spark, sf)
    listed, house = F.startswith("gene", F.lit("QT2")), F.startswith("gene", F.lit("QT3"))
    # Distinct cells per class come from one row per cell, not from sets.
    per = x.groupBy("cell").agg(F.sum(F.when(listed, F.col("reads"))).alias("l"), F.sum("reads").alias("r"), F.max(house).alias("h"), F.sum(F.when(~listed, F.col("rsec_mols"))).alias("m"))
    return per.agg(ag.percent(F.sum("l"), F.sum("r")).alias("pct_listed"), ag.percent(F.count_if("h"), F.count(F.lit(1))).alias("pct_cells_expressing"), (F.sum("m") * 1.0 / F.count("m")).cast("double").alias("mean_mols_without"))


_GS = f"""gs AS (SELECT gene, sum(raw_reads)::BIGINT AS raw_reads, count(*) FILTER (raw_reads > 0) AS raw_molecules, count(*) FILTER (rsec_reads > 0) AS rsec_molecules, count(*) FILTER (rsec_reads = 1) AS rsec_singletons,
  coalesce(sum(rsec_reads), 0)::BIGINT AS rsec_reads, coalesce(sum(dbec_reads), 0)::BIGINT AS dbec_reads, count(*) FILTER (dbec_reads > 0) AS dbec_molecules, min(CASE WHEN dbec_reads > 0 THEN dbec_reads END) AS dbec_min_depth FROM mol GROUP BY gene)"""


@query(
    f"""WITH {SQL_MOL}, {_GS}, panel AS (SELECT gene FROM gs UNION ALL SELECT 'absent'), d AS (SELECT panel.gene, gs.* EXCLUDE gene, 1.0 * raw_reads / nullif(raw_molecules, 0) AS raw_depth, 1.0 * raw_reads / nullif(rsec_molecules, 0) AS rsec_depth,
  1.0 * (rsec_reads - rsec_singletons) / nullif(rsec_molecules - rsec_singletons, 0) AS rsec_depth_multi, 1.0 * dbec_reads / nullif(dbec_molecules, 0) AS dbec_depth,
  100.0 * (rsec_reads - dbec_reads) / nullif(rsec_reads, 0) AS pct_error_reads, 1.0 * (rsec_reads - dbec_reads) / nullif(rsec_molecules - dbec_molecules, 0) AS error_depth FROM panel LEFT JOIN gs ON panel.gene = gs.gene)
SELECT *, CASE WHEN raw_reads IS NULL THEN 'not_detected' WHEN rsec_depth_multi >= 4 THEN 'pass' ELSE 'low_depth' END AS status FROM d"""
)
def a10_gene_summary(spark, sf):
    m = materialize(molecules(spark, sf), "molecules")
    panel = m.select("gene").distinct().union(spark.createDataFrame([("absent",)], "gene string"))
    return ag.gene_summary(m, panel=panel)


@query(f"WITH {SQL_CELL_GENE} SELECT cell, sum(dbec_reads)::BIGINT AS total_reads FROM cell_gene GROUP BY cell HAVING sum(dbec_reads) >= 10")
def a11_cells_by_reads(spark, sf):
    return ag.cells_by_reads(cell_gene(spark, sf), least=10)


_SNR = """CASE WHEN grouping({k}) = 1 THEN 'All' ELSE {k} END AS {k}, avg(CASE WHEN c.cell IS NOT NULL THEN {v} END) AS mean_signal, avg(CASE WHEN c.cell IS NULL THEN {v} END) AS mean_noise,
  median(CASE WHEN c.cell IS NOT NULL THEN {v} END) AS median_signal, median(CASE WHEN c.cell IS NULL THEN {v} END) AS median_noise, 100.0 * sum(CASE WHEN c.cell IS NOT NULL THEN {v} END) / nullif(sum({v}), 0) AS pct_in_cells"""
_SNR2 = "SELECT *, mean_signal / nullif(mean_noise, 0) AS mean_snr, median_signal / nullif(median_noise, 0) AS median_snr FROM s"


@query(f"WITH {SQL_CELL_GENE}, c AS (SELECT cell FROM cell_gene GROUP BY cell HAVING count(*) > 5), p AS (SELECT * FROM cell_gene WHERE gene LIKE 'QT1%'), s AS (SELECT {_SNR.format(k='gene', v='reads')} FROM p LEFT JOIN c ON p.cell = c.cell GROUP BY GROUPING SETS ((gene), ())) {_SNR2}")
def a12_protein_signal_to_noise(spark, sf):
    x = cell_gene(spark, sf)
    cells = x.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 5").select("cell")
    return ag.signal_to_noise(x.filter(F.startswith("gene", F.lit("QT1"))), cells, "cell", "gene", "reads")


@query(f"WITH {SQL_CELL_GENE} SELECT gene, sum(reads)::BIGINT AS reads, 100.0 * sum(reads) / sum(sum(reads)) OVER () AS pct FROM cell_gene WHERE gene LIKE 'QT1%' GROUP BY gene")
def a13_reads_per_protein(spark, sf):
    return ag.count_and_share(cell_gene(spark, sf).filter(F.startswith("gene", F.lit("QT1"))), "gene", F.col("reads"), "reads")


@query(
    f"""WITH {_CALLED2} SELECT idx.cell, coalesce(sum(CASE WHEN kind = 'mrna' THEN reads END), 0)::BIGINT AS mrna, coalesce(sum(CASE WHEN kind = 'protein' THEN reads END), 0)::BIGINT AS protein, bool_or(called.cell IS NOT NULL) AS is_cell
FROM idx LEFT JOIN called ON idx.cell = called.cell GROUP BY idx.cell"""
)
def a14_mrna_and_protein_per_cell(spark, sf):
    totals = sets.pivot(_indexed(spark, sf), "cell", "kind", ["mrna", "protein"], F.sum("reads"), 0)
    return joins.lookup(totals, called_cells(spark, sf).select("cell", F.lit(True).alias("is_cell")), ["cell"], {"is_cell": F.lit(False)})


@query(
    f"""WITH {SQL_TAGS}, {SQL_CALLED}, t AS (SELECT * FROM tags WHERE reads > 0) SELECT CASE WHEN grouping(tag) = 1 THEN 'All_Tags' ELSE tag END AS tag, sum(reads)::BIGINT AS reads, sum(raw_mols)::BIGINT AS mols, count(DISTINCT t.cell) AS cells,
  1.0 * sum(reads) / nullif(sum(raw_mols), 0) AS depth FROM t GROUP BY GROUPING SETS ((tag), ())"""
)
def a15_tag_metrics(spark, sf):
    t = tag_counts(spark, sf).filter("reads > 0")
    return ag.with_total(t, "tag", [F.sum("reads").alias("reads"), F.sum("raw_mols").alias("mols"), F.count_distinct("cell").alias("cells"), F.try_divide(F.sum("reads"), F.sum("raw_mols")).alias("depth")], "All_Tags")


@query(f"WITH {SQL_TAGS}, c AS (SELECT cell FROM tags WHERE reads > 100), s AS (SELECT {_SNR.format(k='tag', v='reads')} FROM tags LEFT JOIN (SELECT DISTINCT cell FROM c) c ON tags.cell = c.cell GROUP BY GROUPING SETS ((tag), ())) {_SNR2}")
def a16_tag_signal_to_noise(spark, sf):
    t = tag_counts(spark, sf)
    return ag.signal_to_noise(t, t.filter("reads > 100").select("cell"), "cell", "tag", "reads")


_CHAIN = """h AS (SELECT sequence_id, split_part(sequence_id, ',', 2)::INTEGER AS cell, split_part(sequence_id, ',', 3) AS umi, split_part(trim(sequence_id), ',', 4) AS chain, gene_type, e_value FROM pyir_hits WHERE sequence_id IS NOT NULL)"""


def _chains(spark, sf):
    part = lambda i: F.split_part("sequence_id", F.lit(","), F.lit(i))
    h = read(spark, sf, "pyir_hits").filter("sequence_id IS NOT NULL")
    return h.select("sequence_id", part(2).cast("int").alias("cell"), part(3).alias("umi"), F.split_part(F.trim("sequence_id"), F.lit(","), F.lit(4)).alias("chain"), "gene_type", "e_value")


@query(f"WITH {_CHAIN} SELECT CASE WHEN grouping(chain) = 1 THEN 'All' ELSE chain END AS chain, count(*) AS hits, count(DISTINCT cell) AS cells, count(DISTINCT sequence_id) AS sequences, 100.0 * count(*) FILTER (e_value < 1e-10) / count(*) AS pct_good FROM h GROUP BY GROUPING SETS ((chain), ())")
def a17_receptor_metrics(spark, sf):
    return ag.with_total(_chains(spark, sf), "chain", [F.count(F.lit(1)).alias("hits"), F.count_distinct("cell").alias("cells"), F.count_distinct("sequence_id").alias("sequences"), ag.percent(F.count_if(F.col("e_value") < 1e-10), F.count(F.lit(1))).alias("pct_good")])


@query(
    f"""WITH {SQL_MOL}, {_GS}, t AS (SELECT count(*)::DOUBLE AS genes, sum(raw_molecules)::DOUBLE AS molecules, sum(rsec_reads)::DOUBLE AS reads, sum(rsec_singletons)::DOUBLE AS singletons FROM gs)
SELECT unnest(['genes', 'molecules', 'reads', 'saturation']) AS metric, unnest([genes, molecules, reads, 100.0 - 100.0 * singletons / reads]) AS value FROM t"""
)
def a18_summary_report(spark, sf):
    g = ag.gene_summary(molecules(spark, sf))
    t = g.agg(F.count(F.lit(1)).cast("double").alias("genes"), F.sum("raw_molecules").cast("double").alias("molecules"), F.sum("rsec_reads").cast("double").alias("reads"), ag.saturation(F.sum("rsec_reads"), F.sum("rsec_singletons")).alias("saturation"))
    return t.unpivot([], ["genes", "molecules", "reads", "saturation"], "metric", "value")


@query(f"WITH {SQL_CELL_GENE} SELECT cell, sum(rsec_mols)::BIGINT AS n_count, count(DISTINCT gene) AS n_features FROM cell_gene WHERE rsec_mols > 0 GROUP BY cell")
def a19_cell_qc(spark, sf):
    return ro.cell_quality(cell_gene(spark, sf), "cell", "rsec_mols")


@query(f"WITH {SQL_MOL} SELECT cell, 100.0 * count(*) FILTER (raw_reads > 1) / count(*) AS pct_deep FROM mol GROUP BY cell")
def a20_pct_deep_molecules(spark, sf):
    return ro.percent_above(molecules(spark, sf), ["cell"], "raw_reads", 1, "pct_deep")


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS customers, max(o_orderdate) AS last FROM orders GROUP BY 1, 2")
def a21_summarise(spark, sf):
    return read(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers"), F.max("o_orderdate").alias("last"))


@query("SELECT sequence_id, coalesce(string_agg(DISTINCT gene_type, '|' ORDER BY gene_type) FILTER (trim(gene_type) <> ''), '-') AS types FROM pyir_hits GROUP BY sequence_id")
def a22_unique_text(spark, sf):
    return read(spark, sf, "pyir_hits").groupBy("sequence_id").agg(ag.unique_text("gene_type").alias("types"))


@query("SELECT n_regionkey, list(n_name ORDER BY n_name) AS names FROM nation GROUP BY 1")
def a23_list_aggregate(spark, sf):
    return ro.lists_by(read(spark, sf, "nation"), ["n_regionkey"], "n_name", "names")


@query("SELECT sample_name, lang, count(*) AS n, 1.0 * count(*) / sum(count(*)) OVER (PARTITION BY sample_name) AS share FROM documents GROUP BY 1, 2")
def a24_cluster_shares(spark, sf):
    n = read(spark, sf, "documents").groupBy("sample_name", "lang").agg(F.count(F.lit(1)).alias("n"))
    return ro.shares_within(n, "sample_name", "n")


@query(
    f"""WITH {SQL_CELL_GENE}, g AS (SELECT split_part(cell, '-', 1) AS sample, gene, sum(rsec_mols)::BIGINT AS total, avg(rsec_mols) AS mean FROM cell_gene GROUP BY 1, 2)
SELECT *, total * 1e6 / nullif(sum(total) OVER (PARTITION BY sample), 0) AS cpm FROM g"""
)
def a25_pseudobulk(spark, sf):
    return ag.pseudobulk(cell_gene(spark, sf).withColumn("sample", F.split_part("cell", F.lit("-"), F.lit(1))), ["sample"], "gene", "rsec_mols")


@query(f"WITH {SQL_CELL_GENE} SELECT gene, sum(rsec_mols)::BIGINT AS total, sum(rsec_mols)::DOUBLE / (SELECT count(DISTINCT cell) FROM cell_gene) AS mean FROM cell_gene GROUP BY gene")
def a26_sparse_means(spark, sf):
    x = materialize(cell_gene(spark, sf).select("cell", "gene", "rsec_mols"), "expression")
    return ag.sparse_means(x, "gene", "rsec_mols", x.select("cell").distinct().count())


@query("SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def a27_distinct(spark, sf):
    return read(spark, sf, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


@query("SELECT l_returnflag, l_linestatus, grouping(l_returnflag)::TINYINT AS g1, grouping(l_linestatus)::TINYINT AS g2, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def a28_grouping_sets(spark, sf):
    return read(spark, sf, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.grouping("l_returnflag").alias("g1"), F.grouping("l_linestatus").alias("g2"), F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


# ---------------------------------------------------------------- windows

_TOT = f"{SQL_CELL_GENE}, t AS (SELECT cell, sum(reads)::BIGINT AS total FROM cell_gene GROUP BY cell)"


def _totals(spark, sf):
    return cell_gene(spark, sf).groupBy("cell").agg(F.sum("reads").alias("total"))


@query(f"WITH {_TOT} SELECT cell, total, row_number() OVER w AS place, sum(total) OVER (w ROWS UNBOUNDED PRECEDING)::BIGINT AS cum FROM t WHERE total > 1 WINDOW w AS (ORDER BY total DESC, cell)")
def w01_running_total(spark, sf):
    return wi.running_total(_totals(spark, sf), "total", "cell")


@query(f"WITH {_TOT}, r AS (SELECT row_number() OVER w AS place, sum(total) OVER (w ROWS UNBOUNDED PRECEDING)::BIGINT AS cum FROM t WHERE total > 1 WINDOW w AS (ORDER BY total DESC, cell)) SELECT place <= 50 AS head, round(regr_slope(log10(cum), log10(place)), 6) AS slope FROM r GROUP BY 1")
def w05_segment_slope(spark, sf):
    return wi.running_total(_totals(spark, sf), "total", "cell").groupBy((F.col("place") <= 50).alias("head")).agg(F.round(wi.log_log_slope(), 6).alias("slope"))


_DISP = f"""{SQL_CELL_GENE}, n AS (SELECT count(DISTINCT cell) AS n FROM cell_gene), s AS (SELECT gene, sum(log10(reads + 1)) AS s, sum(log10(reads + 1) * log10(reads + 1)) AS q, count(*) AS k FROM cell_gene GROUP BY gene),
disp AS (SELECT gene, s / n AS mean, (q - 2 * s / n * s + k * (s / n) * (s / n)) / (n - 1) AS variance, (q - 2 * s / n * s + k * (s / n) * (s / n)) / (n - 1) / (s / n) AS dispersion FROM s, n WHERE s > 0)"""


def _disp(spark, sf):
    x = materialize(cell_gene(spark, sf).select("cell", "gene", "reads"), "expression")
    return wi.dispersion(x, "gene", "reads", x.select("cell").distinct().count())


@query(f"WITH {_DISP} SELECT gene, round(mean, 9) AS mean, round(variance, 9) AS variance, round(dispersion, 9) AS dispersion FROM disp")
def w06_dispersion(spark, sf):
    return _disp(spark, sf).filter("mean > 0").select("gene", *[F.round(c, 9).alias(c) for c in ("mean", "variance", "dispersion")])


_BIN = f"{_DISP}, o AS (SELECT *, row_number() OVER (ORDER BY round(mean, 9), gene) - 1 AS no, count(*) OVER () AS n FROM disp), b AS (SELECT *, CASE WHEN n < 20 THEN 0 ELSE least(no // round_even(n / 20, 0)::BIGINT, 19) END::INTEGER AS bin FROM o)"


@query(f"WITH {_BIN}, z AS (SELECT gene, bin, (dispersion - avg(dispersion) OVER w) / nullif(stddev_samp(dispersion) OVER w, 0) AS z FROM b WINDOW w AS (PARTITION BY bin)) SELECT gene, bin, round(z, 6) AS z FROM z WHERE z >= 1.3")
def w07_variable_genes(spark, sf):
    d = _disp(spark, sf).withColumn("mean", F.round("mean", 9))
    return wi.variable_genes(d, cutoff=1.3).select("gene", "bin", F.round("z", 6).alias("z"))


@query(f"WITH {_DISP}, b AS (SELECT *, ntile(20) OVER (ORDER BY round(mean, 9), gene) - 1 AS bin FROM disp), z AS (SELECT gene, bin::INTEGER AS bin, (dispersion - avg(dispersion) OVER w) / nullif(stddev_pop(dispersion) OVER w, 0) AS z FROM b WINDOW w AS (PARTITION BY bin)) SELECT gene, bin, round(z, 6) AS z FROM z WHERE z > 1.7")
def w08_older_variable_genes(spark, sf):
    d = _disp(spark, sf).filter("mean > 0").withColumn("mean", F.round("mean", 9))
    z = wi.z_in_bins(wi.equal_bins(d, ["mean", "gene"], last_takes_rest=False), "dispersion", "bin", population=True)
    return z.filter("z > 1.7").select("gene", F.col("bin").cast("int").alias("bin"), F.round("z", 6).alias("z"))


@query(
    f"""WITH {SQL_CELL_GENE}, g AS (SELECT gene, sum(reads)::BIGINT AS a, coalesce(sum(CASE WHEN cell LIKE '1%' THEN reads END), 0)::BIGINT AS k FROM cell_gene GROUP BY gene), d AS (SELECT gene, log10(a + 1) - log10(k + 1) AS d FROM g),
s AS (SELECT sum(d) / 1000 AS c, median(d) AS m, stddev_samp(d) AS s FROM d) SELECT gene, round(d - c, 6) AS residual FROM d, s WHERE d - m > 1 * s"""
)
def w09_under_represented(spark, sf):
    g = cell_gene(spark, sf).groupBy("gene").agg(F.sum("reads").alias("a"), F.coalesce(F.sum(F.when(F.startswith("cell", F.lit("1")), F.col("reads"))), F.lit(0)).alias("k"))
    return wi.under_represented(g, "gene", "a", "k", 1000, 1).select("gene", F.round("residual", 6).alias("residual"))


@query(f"WITH {SQL_CELL_GENE}, g AS (SELECT gene, sum(reads)::BIGINT AS v FROM cell_gene GROUP BY gene), b AS (SELECT v, sum(v) AS s FROM g GROUP BY v), f AS (SELECT v, sum(s) OVER (ORDER BY v) / sum(s) OVER () AS f FROM b) SELECT coalesce(max(v) FILTER (f <= 0.05), 0)::BIGINT AS threshold FROM f")
def w10_count_threshold(spark, sf):
    g = cell_gene(spark, sf).groupBy("gene").agg(F.sum("reads").alias("v"))
    return wi.count_threshold(g, "v", 0.05)


@query(
    f"""WITH {_TOT}, r AS (SELECT total AS v, row_number() OVER w AS k, count(*) OVER () AS n, lead(total) OVER w AS after FROM t WINDOW w AS (ORDER BY total DESC, cell)),
q AS (SELECT * FROM r WHERE k > n - ceil(n / 4) AND after IS NOT NULL) SELECT v AS cutoff, v - after AS jump FROM q ORDER BY after - v, k LIMIT 1"""
)
def w11_largest_drop(spark, sf):
    return wi.largest_drop(_totals(spark, sf), "total", "cell")


@query(f"WITH {SQL_MOL} SELECT cell, gene, umi, raw_reads FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY raw_reads DESC NULLS LAST, gene, umi, mol_id) AS k FROM mol) WHERE k = 1")
def w12_dominant_per_group(spark, sf):
    return wi.best_per_group(molecules(spark, sf), ["cell"], [F.desc("raw_reads"), F.asc("gene"), F.asc("umi"), F.asc("mol_id")]).select("cell", "gene", "umi", "raw_reads")


@query("SELECT sequence_id, gene, n FROM (SELECT sequence_id, gene, count(*) AS n, row_number() OVER (PARTITION BY sequence_id ORDER BY count(*) DESC, gene) AS k FROM pyir_hits WHERE gene IS NOT NULL GROUP BY 1, 2) WHERE k = 1")
def w13_most_frequent(spark, sf):
    return wi.most_frequent(read(spark, sf, "pyir_hits").filter("gene IS NOT NULL"), ["sequence_id"], "gene")


@query("SELECT sequence_id, gene, e_value FROM (SELECT *, row_number() OVER (PARTITION BY sequence_id ORDER BY n DESC, gene_type NULLS LAST, e_value NULLS LAST, gene, bit_score DESC NULLS LAST, percent_identity DESC NULLS LAST, loaded_at) AS k FROM (SELECT *, count(*) OVER (PARTITION BY sequence_id, gene) AS n FROM pyir_hits)) WHERE k = 1")
def w14_representative(spark, sf):
    h = read(spark, sf, "pyir_hits")
    # Counted by an aggregate and joined back: a sequence with very many hits is no window of its own.
    n = h.groupBy("sequence_id", "gene").agg(F.count(F.lit(1)).alias("n")).select(F.col("sequence_id").alias("s"), F.col("gene").alias("g"), "n")
    h = h.join(n, F.col("sequence_id").eqNullSafe(F.col("s")) & F.col("gene").eqNullSafe(F.col("g"))).drop("s", "g")
    order = [F.desc("n"), F.asc_nulls_last("gene_type"), F.asc_nulls_last("e_value"), F.asc_nulls_last("gene"), F.desc_nulls_last("bit_score"), F.desc_nulls_last("percent_identity"), F.asc("loaded_at")]
    return wi.best_per_group(h, ["sequence_id"], order).select("sequence_id", "gene", "e_value")


@query("SELECT p_brand, p_partkey, p_size, rank_no::INTEGER AS rank_no FROM (SELECT *, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS rank_no FROM part) WHERE rank_no <= 3")
def w15_top_with_ties(spark, sf):
    return wi.top_with_ties(read(spark, sf, "part"), ["p_brand"], "p_size", 3).select("p_brand", "p_partkey", "p_size", "rank_no")


@query("SELECT p_partkey, round((p_retailprice - avg(p_retailprice) OVER w) / nullif(stddev_samp(p_retailprice) OVER w, 0), 6) AS z FROM part WINDOW w AS (PARTITION BY p_brand)")
def w16_scaled_rows(spark, sf):
    return wi.scaled(read(spark, sf, "part"), ["p_brand"], "p_retailprice").select("p_partkey", F.round("z", 6).alias("z"))


@query("SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last, string_agg(strftime(o_orderdate, '%Y-%m-%d'), ';' ORDER BY o_orderdate, o_orderkey) AS dates FROM orders GROUP BY 1")
def w17_ordered_series(spark, sf):
    return ro.ordered_series(read(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_orderkey")


@query(
    f"""WITH {SQL_TAGS}, m AS (SELECT tag, median(reads) AS m FROM tags GROUP BY tag), d AS (SELECT tags.*, abs(reads - m) AS d FROM tags JOIN m USING (tag)), s AS (SELECT tag, median(d) AS s FROM d GROUP BY tag)
SELECT d.cell, d.tag, d.reads FROM d JOIN s USING (tag) WHERE d / (CASE WHEN s = 0 THEN 1 ELSE s END) < 4"""
)
def w18_without_outliers(spark, sf):
    return wi.without_outliers(tag_counts(spark, sf), ["tag"], "reads", 4.0).select("cell", "tag", "reads")


@query(
    f"""WITH {_TOT}, x AS (SELECT cell, split_part(cell, '-', 1) AS sample, ln(total) AS x FROM t), m AS (SELECT sample, median(x) AS m FROM x GROUP BY sample), s AS (SELECT x.sample, 1.4826 * median(abs(x - m)) AS s FROM x JOIN m USING (sample) GROUP BY x.sample)
SELECT cell, x < m - 3 * s OR x > m + 3 * s AS outlier FROM x JOIN m USING (sample) JOIN s USING (sample)"""
)
def w19_outlier_cells(spark, sf):
    x = _totals(spark, sf).withColumn("sample", F.split_part("cell", F.lit("-"), F.lit(1)))
    return wi.is_outlier(x, ["sample"], "total", 3, upper=True, log=True).select("cell", "outlier")


@query(
    """WITH p AS (SELECT DISTINCT sequence_id, gene, e_value AS p FROM pyir_hits WHERE e_value IS NOT NULL AND e_value <= 1 AND sequence_id IS NOT NULL AND gene IS NOT NULL), r AS (SELECT *, count(*) OVER () AS n, rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1 AS r FROM p)
SELECT sequence_id, gene, p, least(1.0, min(p * n / r) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING)) AS q FROM r"""
)
def w20_adjusted_p(spark, sf):
    p = read(spark, sf, "pyir_hits").filter("e_value <= 1").select("sequence_id", "gene", F.col("e_value").alias("p")).dropna().distinct()
    return wi.adjust_p(p, "p")


@query("SELECT c_custkey, greatest(-q, least(q, c_acctbal)) AS clipped FROM customer, (SELECT quantile_cont(abs(c_acctbal), 0.99) AS q FROM customer)")
def w21_clipped(spark, sf):
    return wi.clipped(read(spark, sf, "customer"), "c_acctbal").select("c_custkey", "clipped")


@query(
    f"""WITH {SQL_MOL}, c AS (SELECT ({sql_digest_number("mol_id", seed=7)} % 100)::INTEGER AS step, gene, count(*) AS n FROM mol GROUP BY 1, 2), d AS (SELECT step, sum(n) AS n FROM c GROUP BY 1),
g AS (SELECT step, count(*) AS g FROM (SELECT gene, min(step) AS step FROM c WHERE gene IS NOT NULL GROUP BY 1) GROUP BY 1)
SELECT step, sum(coalesce(n, 0)) OVER (ORDER BY step)::BIGINT AS depth, sum(coalesce(g, 0)) OVER (ORDER BY step)::BIGINT AS detected FROM d FULL JOIN g USING (step)"""
)
def w22_saturation(spark, sf):
    return wi.saturation_curve(molecules(spark, sf), "mol_id", "gene")


# ---------------------------------------------------------------- sets, sorts, pivots


@query(f"WITH {SQL_CELL_GENE} SELECT gene, cell, reads FROM cell_gene")
def o01_sorted_by_gene_and_cell(spark, sf):
    return ro.range_sorted(cell_gene(spark, sf).select("gene", "cell", "reads"), ["gene", "cell"])


@query(f"WITH {SQL_MOL} SELECT cell, gene, umi, raw_reads FROM mol")
def o02_sorted_by_cell_gene_umi(spark, sf):
    return ro.range_sorted(molecules(spark, sf).select("cell", "gene", "umi", "raw_reads"), ["cell", "gene", "umi"])


@query("SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def o03_concatenate(spark, sf):
    return sets.stack([read(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")), read(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))])


@query(f"WITH {SQL_CELL_GENE} SELECT gene, gene LIKE 'QT1%' AS is_protein, row_number() OVER (ORDER BY gene LIKE 'QT1%' DESC, gene)::INTEGER AS place FROM (SELECT DISTINCT gene FROM cell_gene)")
def o04_gene_order(spark, sf):
    return ro.gene_order(cell_gene(spark, sf), "gene", F.startswith("gene", F.lit("QT1"))).withColumnRenamed("is_first", "is_protein")


@query("SELECT 500 AS n, 500 AS distinct_ids")
def o05_sample_exactly(spark, sf):
    return sets.sample_exactly(read(spark, sf, "orders"), ["o_orderkey"], 500).agg(F.count(F.lit(1)).cast("int").alias("n"), F.count_distinct("o_orderkey").cast("int").alias("distinct_ids"))


@query(f"SELECT * FROM orders WHERE {sql_digest_number('o_orderkey', seed=42)} < {int(0.2 * 2**32)}")
def o06_sample_share(spark, sf):
    return sets.sample_share(read(spark, sf, "orders"), ["o_orderkey"], 0.2)


@query("SELECT c_mktsegment, ceil(count(*) * 0.1)::BIGINT AS n FROM customer GROUP BY 1")
def o07_sample_by_group(spark, sf):
    return sets.sample_by_group(read(spark, sf, "customer"), "c_mktsegment", ["c_custkey"], 0.1).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT cell, coalesce(COLUMNS(* EXCLUDE (cell)), 0) FROM (PIVOT (WITH {SQL_TAGS} SELECT cell, tag, reads FROM tags) ON tag USING avg(reads) GROUP BY cell)")
def o08_pivot_all_tags(spark, sf):
    """A column for every tag that occurs."""
    t = materialize(tag_counts(spark, sf), "tags")
    return sets.pivot(t, "cell", "tag", attributes_of(t.select(F.col("tag").alias("attribute"))), F.avg("reads"), 0.0)


@query(f"WITH {SQL_TAGS} SELECT cell, tag, name, value FROM (SELECT cell, tag, reads, dbec_reads, raw_mols FROM tags) UNPIVOT (value FOR name IN (reads, dbec_reads, raw_mols))")
def o09_unpivot_long(spark, sf):
    return unpivot(tag_counts(spark, sf), ["cell", "tag"], ["reads", "dbec_reads", "raw_mols"])


@query(f"WITH {SQL_TAGS} SELECT c.cell, t.tag, coalesce(x.reads, 0) AS reads FROM (SELECT DISTINCT cell FROM tags) c CROSS JOIN (SELECT DISTINCT tag FROM tags) t LEFT JOIN tags x ON x.cell = c.cell AND x.tag = t.tag")
def o10_complete(spark, sf):
    return joins.complete(tag_counts(spark, sf).select("cell", "tag", "reads"), "cell", "tag", {"reads": 0})


@query("SELECT n_name AS name, n_nationkey AS nation, NULL::INTEGER AS region FROM nation UNION ALL SELECT r_name, NULL, r_regionkey FROM region")
def o11_bind_rows(spark, sf):
    return sets.stack([read(spark, sf, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("nation")), read(spark, sf, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("region"))])


@query("SELECT 'union' AS op, count(*) AS n FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT 'intersect', count(*) FROM (SELECT l_partkey FROM lineitem WHERE l_quantity > 45 INTERSECT SELECT p_partkey FROM part WHERE p_size > 20) UNION ALL SELECT 'setdiff', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)")
def o12_set_operations(spark, sf):
    t = lambda n, c, e="true": read(spark, sf, n).filter(e).select(F.col(c).alias("x"))
    n = lambda d, op: d.agg(F.lit(op).alias("op"), F.count(F.lit(1)).alias("n"))
    u = t("customer", "c_nationkey").union(t("supplier", "s_nationkey")).distinct()
    i = t("lineitem", "l_partkey", "l_quantity > 45").intersect(t("part", "p_partkey", "p_size > 20"))
    d = t("customer", "c_custkey").subtract(t("orders", "o_custkey"))
    return n(u, "union").unionByName(n(i, "intersect")).unionByName(n(d, "setdiff"))


@query("SELECT combination, count(*) AS n_items FROM (SELECT gene, string_agg(DISTINCT gene_type, '&' ORDER BY gene_type) AS combination FROM pyir_hits WHERE gene IS NOT NULL AND gene_type IS NOT NULL GROUP BY gene) GROUP BY combination")
def o13_set_combinations(spark, sf):
    return sets.combinations(read(spark, sf, "pyir_hits"), "gene_type", "gene")


@query(
    """WITH m AS (SELECT DISTINCT l_returnflag || l_linestatus || l_linenumber AS s, l_partkey AS i FROM lineitem), n AS (SELECT s, count(*) AS n FROM m GROUP BY s), b AS (SELECT a.s AS set_a, b.s AS set_b, count(*) AS both FROM m a JOIN m b ON a.i = b.i AND a.s < b.s GROUP BY 1, 2)
SELECT set_a, set_b, "both", "both"::DOUBLE / (x.n + y.n - "both") AS jaccard FROM b JOIN n x ON x.s = set_a JOIN n y ON y.s = set_b"""
)
def o14_jaccard(spark, sf):
    li = read(spark, sf, "lineitem").select(F.concat("l_returnflag", "l_linestatus", "l_linenumber").alias("s"), "l_partkey")
    return sets.jaccard(li, "s", "l_partkey")


@query(f"WITH {SQL_TAGS}, t AS (SELECT DISTINCT tag FROM tags UNION SELECT unnest(['All_Tags', 'Multiplet', 'Undetermined'])) SELECT tag, row_number() OVER (ORDER BY CASE tag WHEN 'All_Tags' THEN 0 WHEN 'Multiplet' THEN 2 WHEN 'Undetermined' THEN 3 ELSE 1 END, tag)::INTEGER AS place FROM t")
def o15_fixed_order(spark, sf):
    t = tag_counts(spark, sf).select("tag").distinct().union(spark.createDataFrame([("All_Tags",), ("Multiplet",), ("Undetermined",)], "tag string"))
    return sets.in_fixed_order(t, "tag", ["All_Tags"], ["Multiplet", "Undetermined"])


@query(f"WITH {SQL_CELL_GENE} SELECT cell, map_from_entries(list((gene, rsec_mols) ORDER BY gene))::VARCHAR AS counts FROM cell_gene WHERE rsec_mols > 0 GROUP BY cell")
def o16_sparse_rows(spark, sf):
    return ro.sparse_rows(cell_gene(spark, sf), "cell", "gene", "rsec_mols")
