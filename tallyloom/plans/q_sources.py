"""Queries of the sources (S): lines drawn from the test tables are parsed, and compared with the tables themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import sql_digest_number
from ..operators import splits
from ..operators.wide import attributes_of
from ..sources import alignments as al, annotation as an, fastq as fq, sequences as sq, tables as tb
from .bindings import SQL_CALLED, SQL_CELL_GENE, SQL_READS, called_cells, cell_gene, reads
from .registry_helpers import book
from .tables import read

QUERIES, SQL, query = book()

_KIND = "CASE WHEN p_size % 3 = 0 THEN 'gene' ELSE 'exon' END"


def _gtf(spark, sf):
    p = read(spark, sf, "part")
    attrs = F.concat(F.lit('gene_id "g'), F.col("p_partkey"), F.lit('"; transcript_id "t'), F.floor(F.col("p_partkey") / 4), F.lit('"; gene_name "'), F.col("p_brand"), F.lit('";'))
    cols = [F.col("p_type"), F.lit("lab"), F.when(F.col("p_size") % 3 == 0, "gene").otherwise("exon"), F.col("p_partkey").cast("string"), (F.col("p_partkey") + F.col("p_size")).cast("string"), F.lit("."), F.when(F.col("p_size") % 2 == 0, "+").otherwise("-"), F.lit("."), attrs]
    lines = p.select(F.concat_ws("\t", *cols).alias("value"))
    return lines.union(spark.createDataFrame([("##gff-version 2",), ("",)], "value string"))


@query(f"WITH {SQL_READS} SELECT read_id::VARCHAR AS read_id, CASE WHEN target = '*' THEN NULL ELSE target END AS reference, position, cigar, library AS lb, status AS st FROM reads")
def s04_sam_lines(spark, sf):
    r = reads(spark, sf)
    tags = F.create_map(F.lit("LB"), F.col("library"), F.lit("XS"), F.col("status"))
    rows = r.select(F.col("read_id").cast("string").alias("read_id"), F.lit(0).alias("flag"), F.col("target").alias("reference"), "position", F.lit(60).alias("mapq"), "cigar", F.col("r2_seq").alias("seq"), F.col("r2_qual").alias("qual"), tags.alias("tags"))
    s = al.parse_sam(al.as_sam_lines(rows).union(spark.createDataFrame([("@HD\tVN:1.6",)], "value string")))
    return s.select("read_id", "reference", "position", "cigar", F.col("tags")["LB"].alias("lb"), F.col("tags")["XS"].alias("st"))


@query(f"SELECT p_type AS seqname, {_KIND} AS feature, p_partkey::INTEGER AS \"start\", (p_partkey + p_size)::INTEGER AS \"end\", CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, 'g' || p_partkey AS gene_id, p_brand AS gene_name FROM part")
def s05_feature_lines(spark, sf):
    f = an.parse_features(_gtf(spark, sf))
    return f.select("seqname", "feature", "start", "end", "strand", F.col("attributes")["gene_id"].alias("gene_id"), F.col("attributes")["gene_name"].alias("gene_name"))


@query(f"SELECT 'g' || p_partkey AS gene_id FROM part WHERE p_type = 'PROMO' AND {_KIND} = 'gene' AND p_brand = 'Brand#1'")
def s06_feature_filter(spark, sf):
    f = an.filter_features(an.parse_features(_gtf(spark, sf)), ["PROMO"], ["gene"], ["lab"], {"gene_name": "Brand#1"})
    return f.select(F.col("attributes")["gene_id"].alias("gene_id"))


@query(f"SELECT {_KIND} AS feature, count(*) AS n, count(*) FILTER ((p_size + 1) % 3 = 0) AS closed, count(*) FILTER (p_size % 3 = 0) AS half_open FROM part GROUP BY 1")
def s07_feature_stats(spark, sf):
    return an.feature_stats(an.parse_features(_gtf(spark, sf)))


@query(
    """WITH g AS (SELECT 'r' || r_regionkey AS id, NULL AS up FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation), l AS (SELECT s_suppkey, 'n' || s_nationkey AS p FROM supplier UNION ALL SELECT NULL, up FROM g WHERE up IS NOT NULL)
SELECT l.s_suppkey::INTEGER AS "start", CASE WHEN l.s_suppkey IS NULL THEN 'transcript' ELSE 'exon' END AS feature, coalesce(g.up, l.p) AS gene_id, l.p AS transcript_id FROM l LEFT JOIN g ON l.p = g.id"""
)
def s08_parents_to_ids(spark, sf):
    line = lambda kind, start, attrs: F.concat_ws("\t", F.lit("c"), F.lit("lab"), F.lit(kind), start, F.lit("9"), F.lit("."), F.lit("+"), F.lit("."), attrs)
    t = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    r = read(spark, sf, "region").select(line("gene", F.lit("."), F.concat(F.lit("ID=id:"), t("r", "r_regionkey"))).alias("value"))
    n = read(spark, sf, "nation").select(line("mRNA", F.lit("."), F.concat(F.lit("ID=id:"), t("n", "n_nationkey"), F.lit(";Parent=id:"), t("r", "n_regionkey"))).alias("value"))
    s = read(spark, sf, "supplier").select(line("CDS", F.col("s_suppkey").cast("string"), F.concat(F.lit("Parent=id:"), t("n", "s_nationkey"))).alias("value"))
    g = an.to_gtf(an.parse_features(r.union(n).union(s), style="gff3"), "id:", {"CDS": "exon", "mRNA": "transcript"})
    return g.select("start", "feature", "gene_id", "transcript_id")


@query(f"SELECT p_brand AS feature, count(*) AS n FROM part WHERE {_KIND} = 'exon' GROUP BY 1")
def s09_countable_features(spark, sf):
    return an.countable_features(an.parse_features(_gtf(spark, sf))).groupBy("feature").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT 't' || (p_partkey // 4) AS transcript_id, sum(p_size + 1)::BIGINT AS length FROM part WHERE {_KIND} = 'exon' GROUP BY 1")
def s10_transcript_lengths(spark, sf):
    return an.transcript_lengths(an.parse_features(_gtf(spark, sf)))


@query("SELECT n_name AS seqname, f AS feature, n_nationkey + 100 AS \"end\", n_name AS gene_id FROM nation, (SELECT unnest(['exon', 'gene']) AS f)")
def s11_spike_in_features(spark, sf):
    n = read(spark, sf, "nation").select(F.col("n_name").alias("name"), (F.col("n_nationkey") + 100).alias("length"))
    return an.spike_in_features(n).select("seqname", "feature", "end", F.col("attributes")["gene_id"].alias("gene_id"))


def _fasta(spark, sf):
    r = reads(spark, sf)
    return sq.parse_fasta(r.select(F.concat(F.lit(">"), F.substring("r1_seq", 1, 3), F.lit(" of "), F.col("library"), F.lit("\n"), F.substring("r2_seq", 1, 4), F.lit("\n"), F.substring("r2_seq", 5, 2), F.lit("\n")).alias("value")))


@query(f"WITH {SQL_READS} SELECT substr(r1_seq, 1, 3) AS name, substr(r1_seq, 1, 3) || ' of ' || library AS description, substr(r2_seq, 1, 6) AS seq FROM reads")
def s12_fasta_entries(spark, sf):
    return _fasta(spark, sf)


@query(
    f"""WITH {SQL_READS}, f AS (SELECT substr(r1_seq, 1, 3) AS name, substr(r2_seq, 1, 6) AS seq FROM reads) SELECT 'repeated id' AS problem, name, count(*) AS n FROM f GROUP BY name HAVING count(*) > 1
UNION ALL SELECT 'repeated sequence', min(name), count(DISTINCT name) FROM f GROUP BY seq HAVING count(DISTINCT name) > 1"""
)
def s13_reference_problems(spark, sf):
    return sq.reference_problems(_fasta(spark, sf))


@query("SELECT true AS tags, false AS proteins")
def s14_has_targets(spark, sf):
    t = read(spark, sf, "sample_tag_cell").select(F.col("tag").alias("name")).filter("name IS NOT NULL")
    return spark.createDataFrame([(sq.has_targets(t, ("stAbO",)), sq.has_targets(t, ("pAbO",)))], "tags boolean, proteins boolean")


@query("SELECT n_name AS library, (n_regionkey + 1)::VARCHAR AS lane, n_name || '_S1_L00' || (n_regionkey + 1) || '_R1_001.fastq.gz' AS r1, CASE WHEN n_regionkey <> 2 THEN n_name || '_S1_L00' || (n_regionkey + 1) || '_R2_001.fastq.gz' END AS r2 FROM nation")
def s15_paired_files(spark, sf):
    n = read(spark, sf, "nation").withColumn("mate", F.explode(F.when(F.col("n_regionkey") != 2, F.array(F.lit("1"), F.lit("2"))).otherwise(F.array(F.lit("1")))))
    files = n.select(F.concat("n_name", F.lit("_S1_L00"), F.col("n_regionkey") + 1, F.lit("_R"), "mate", F.lit("_001.fastq.gz")).alias("name"))
    return fq.paired_files(files).select("library", F.regexp_replace("lane", "^0+", "").alias("lane"), "r1", "r2")


@query(f"WITH {SQL_READS} SELECT read_id FROM reads WHERE {sql_digest_number('read_id', seed=42)} < {int(0.25 * 2**32)}")
def s16_subsample(spark, sf):
    return fq.subsample(reads(spark, sf), 0.25).select("read_id")


@query(f"SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 + 1 AS INTEGER) AS chunk_no FROM orders WHERE {sql_digest_number('o_orderkey', seed=42)} < {2**31}")
def s17_sampled_chunks(spark, sf):
    return splits.chunks(read(spark, sf, "orders"), ["o_orderkey"], 1000, 0.5).select("o_orderkey", "chunk_no")


@query(
    """WITH k AS (SELECT l_suppkey, sum(l_quantity) AS w FROM lineitem GROUP BY 1), p AS (SELECT l_suppkey, CAST(floor((sum(w) OVER (ORDER BY l_suppkey) - w) / 20000) + 1 AS INTEGER) AS part_no FROM k)
SELECT l_orderkey, l_linenumber, l_suppkey, part_no FROM lineitem JOIN p USING (l_suppkey)"""
)
def s18_parts_on_key_boundaries(spark, sf):
    return splits.on_key_boundaries(read(spark, sf, "lineitem"), "l_suppkey", F.col("l_quantity"), 20_000).select("l_orderkey", "l_linenumber", "l_suppkey", "part_no")


@query("SELECT p_partkey, CAST(floor((row_number() OVER (ORDER BY p_partkey) - 1) * 7 / count(*) OVER ()) + 1 AS INTEGER) AS part_no FROM part")
def s19_equal_parts(spark, sf):
    return splits.parts_of(read(spark, sf, "part"), ["p_partkey"], 7).select("p_partkey", "part_no")


@query(f"WITH {SQL_CALLED} SELECT cell, count(*) AS n FROM molecule SEMI JOIN called USING (cell) GROUP BY cell")
def s20_rows_of_cells(spark, sf):
    m = tb.of_cells(read(spark, sf, "molecule"), called_cells(spark, sf), "cell")
    return m.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'region' AS section, 'name' AS metric, r_name AS value FROM region UNION ALL SELECT 'region', 'key', r_regionkey::VARCHAR FROM region UNION ALL SELECT 'nation', 'name', n_name FROM nation")
def s21_sectioned_report(spark, sf):
    r = read(spark, sf, "region").select(F.col("r_regionkey").alias("k"), F.concat_ws(",", "r_name", "r_regionkey").alias("value"))
    n = read(spark, sf, "nation").select((F.col("n_nationkey") + 100).alias("k"), F.col("n_name").alias("value"))
    heads = spark.createDataFrame([(-9, "## Sample: s"), (-3, "#region#"), (-2, "name,key"), (90, ""), (91, "#nation#"), (92, "name")], "k int, value string")
    lines = r.union(n).union(heads).select(F.lit("f").alias("file"), F.col("k").alias("line_no"), "value")
    return tb.section_metrics(tb.parse_sections(lines)).select("section", "metric", "value")


@query("SELECT 'Assay' AS name, 'WTA' AS value UNION ALL SELECT 'Sample', 'a:b'")
def s22_run_header(spark, sf):
    h = tb.run_header(["####", "## Assay: WTA", "## Sample: a:b", "x"])
    return spark.createDataFrame([*h.items()], "name string, value string")


@query(f"WITH {SQL_CELL_GENE} SELECT cell, gene, raw_mols::DOUBLE AS v FROM cell_gene")
def s23_matrix_triplets(spark, sf):
    body, r, c = tb.as_matrix_market(cell_gene(spark, sf), "cell", "gene", "raw_mols")
    t = tb.parse_matrix_market(body.union(spark.createDataFrame([("%%MatrixMarket matrix coordinate",)], "value string")))
    return t.join(r.withColumnRenamed("no", "i"), "i").join(c.withColumnRenamed("no", "j"), "j").select("cell", "gene", "v")


@query("SELECT p_brand AS gene, sample, n FROM (SELECT p_brand, sum(p_size)::DOUBLE AS a, count(*)::DOUBLE AS b FROM part GROUP BY 1) UNPIVOT (n FOR sample IN (a, b)) WHERE true")
def s24_feature_counts(spark, sf):
    t = read(spark, sf, "part").groupBy(F.col("p_brand").alias("Geneid")).agg(F.lit("c").alias("Chr"), F.lit(1).alias("Length"), F.sum("p_size").alias("a"), F.count(F.lit(1)).alias("b"))
    return tb.feature_counts(t)


@query("SELECT p_type AS gene, coalesce(COLUMNS(* EXCLUDE (p_type)), 0)::BIGINT FROM (PIVOT (SELECT p_type, p_brand, p_size FROM part WHERE p_brand IS NOT NULL) ON p_brand USING sum(p_size) GROUP BY p_type)")
def s25_all_samples(spark, sf):
    """A column for every brand that occurs."""
    p = read(spark, sf, "part").withColumnRenamed("p_type", "gene").filter("p_brand IS NOT NULL")
    return tb.stacked_samples(p, "gene", "p_brand", "p_size", attributes_of(p.select(F.col("p_brand").alias("attribute"))))
