"""Queries of the per-read operators (R) and the molecule operators (M), with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels, reads as rd
from ..operators import joins, labels as lb, molecules as mo, rollups as ro
from ..session import materialize
from .bindings import SQL_CALLED, SQL_CELL_GENE, SQL_MOL, SQL_READS, called_cells, cell_gene, molecules, reads
from .registry_helpers import book
from .tables import read

QUERIES, SQL, query = book()

_Q = "list_sum([ascii(c) - 33 for c in string_split({q}, '')]) / length({q})"
_B = "greatest({}) / length({{s}})".format(", ".join(f"length({{s}}) - length(replace({{s}}, '{b}', ''))" for b in "ACTGN"))


@query(f"WITH {SQL_READS} SELECT read_id, length(r1_seq) AS size, {_Q.format(q='r1_qual')} AS mean_quality, {_B.format(s='r1_seq')} AS top_share FROM reads")
def r01_read_stats(spark, sf):
    r = reads(spark, sf)
    return r.select("read_id", F.length("r1_seq").cast("bigint").alias("size"), rd.mean_quality(F.col("r1_qual")).alias("mean_quality"), rd.top_base_share(F.col("r1_seq")).alias("top_share"))


_CHECKS = f"""checked AS (SELECT *, length(substr(r1_seq, 1, 75)) < 60 OR length(r2_seq) < 42 AS fails_length,
  {_Q.format(q='r1_qual')} < 38 OR {_Q.format(q='r2_qual')} < 38 AS fails_quality, {_B.format(s='r1_seq')} >= 0.45 OR {_B.format(s='r2_seq')} >= 0.45 AS fails_base FROM reads)"""


def _checked(spark, sf):
    r = reads(spark, sf)
    c = [F.col(x) for x in ("r1_seq", "r1_qual", "r2_seq", "r2_qual")]
    return r.withColumns(rd.quality_checks(*c, min_quality=38, max_r1=0.45, max_r2=0.45))


@query(f"WITH {SQL_READS}, {_CHECKS} SELECT read_id, r1_seq FROM checked WHERE NOT (fails_length OR fails_quality OR fails_base)")
def r02_quality_pass(spark, sf):
    return _checked(spark, sf).filter("NOT (fails_length OR fails_quality OR fails_base)").select("read_id", "r1_seq")


@query(
    f"""WITH {SQL_READS}, {_CHECKS} SELECT library, count(*) AS total, count(*) FILTER (NOT fails_length) AS after_length, count(*) FILTER (NOT fails_quality) AS after_quality,
  count(*) FILTER (NOT fails_base) AS after_base, count(*) FILTER (NOT (fails_length OR fails_quality OR fails_base)) AS after_all FROM checked GROUP BY library"""
)
def r03_filter_funnel(spark, sf):
    c = _checked(spark, sf)
    n = lambda e, a: F.count_if(F.expr(e)).alias(a)
    return c.groupBy("library").agg(F.count(F.lit(1)).alias("total"), n("NOT fails_length", "after_length"), n("NOT fails_quality", "after_quality"), n("NOT fails_base", "after_base"), n("NOT (fails_length OR fails_quality OR fails_base)", "after_all"))


@query(f"WITH {SQL_READS} SELECT read_id, substr(r1_seq, 1, 8) AS section_1, substr(r1_seq, 21, 8) AS section_2, substr(r1_seq, 41, 8) AS section_3, substr(r1_seq, 49, 8) AS umi, substr(r1_seq, 57) AS poly_t FROM reads")
def r04_label_slices(spark, sf):
    return reads(spark, sf).select("read_id", *[c.alias(n) for n, c in rd.label_slices(F.col("r1_seq"), 1).items()])


_WHITE = [a + b + c for a in "ACGT" for b in "ACGT" for c in "ACGT"][:48]  # a stand-in of fixed size
_WHITE_SQL = "[" + ", ".join(f"'{w}'" for w in _WHITE) + "]"


@query(f"WITH {SQL_READS} SELECT read_id, nullif(list_position({_WHITE_SQL}, substr(r1_seq, 1, 3)), 0)::INTEGER AS section_no FROM reads")
def r05_whitelist_exact(spark, sf):
    return reads(spark, sf).select("read_id", rd.whitelist_index(F.substring("r1_seq", 1, 3), _WHITE).alias("section_no"))


def _scheme() -> lb.LabelScheme:
    """A stand-in scheme by rule: every section has the 96 first words of eight letters whose codes differ in several places."""
    words = ["".join("ACGT"[(i * m // 7 + i // 4**j) % 4] for j, m in enumerate((1, 3, 5, 9, 11, 2, 6, 13))) for i in range(3, 1200, 11)]
    return lb.LabelScheme([list(dict.fromkeys(words))[:96]] * 3, ("ACTGGCCTGCGA", "GGTAGCGGTGAC"), 1)


@query()
def r06_label_annotation(spark, sf):
    """Reads built from labels by the scheme, some with a substitution or a lost base, annotated again."""
    s = _scheme()
    r = reads(spark, sf)
    k = F.col("read_id")
    n = len(s.sections[0])
    word = lambda i, c: F.element_at(F.array(*[F.lit(w) for w in s.sections[i]]), (c % n + 1).cast("int"))
    whole = F.concat(word(0, k), F.lit(s.linkers[0]), word(1, F.floor(k / 7)), F.lit(s.linkers[1]), word(2, F.floor(k / 13)), F.substring("r2_seq", 1, 8), F.lit("TTTTTTTTTT"))
    seen = F.when(k % 5 == 0, F.overlay(whole, F.lit("A"), F.lit(4))).when(k % 5 == 1, F.overlay(whole, F.lit(""), F.lit(23), F.lit(1))).otherwise(whole)
    return lb.annotate_labels(r.select("read_id", seen.alias("seq")), s)


_KEYS8 = ["ACGTACGT", "AAAACCCC", "GGGGTTTT", "TTTTACGT", "CCCCAGAG", "GATTACAG", "CATCATCA", "TGTGTGTG"]
_KEYS8_SQL = "[" + ", ".join(f"'{w}'" for w in _KEYS8) + "]"


@query(
    f"""WITH {SQL_MOL}, u AS (SELECT DISTINCT umi FROM mol WHERE umi IS NOT NULL), d AS (SELECT umi, [levenshtein(umi, w) for w in {_KEYS8_SQL}] AS ds FROM u),
b AS (SELECT umi, ds, list_min(ds) AS best FROM d)
SELECT umi, CASE WHEN best <= 4 AND len([x for x in ds if x = best]) = 1 THEN list_position(ds, best)::INTEGER END AS place,
  CASE WHEN best <= 4 AND len([x for x in ds if x = best]) = 1 THEN best::INTEGER END AS distance FROM b"""
)
def r06_whitelist_nearest(spark, sf):
    return joins.nearest_whitelisted(molecules(spark, sf), "umi", _KEYS8, 4)


@query(f"WITH {SQL_READS} SELECT read_id, CASE WHEN length(substr(r1_seq, 57)) >= 7 THEN length(substr(r1_seq, 57, 8)) - length(replace(substr(r1_seq, 57, 8), 'T', '')) >= 6 ELSE true END AS passes FROM reads")
def r07_poly_t(spark, sf):
    return reads(spark, sf).select("read_id", rd.poly_t_passes(rd.label_slices(F.col("r1_seq"), 1)["poly_t"]).alias("passes"))


_V = "(strpos('ACGT', substr(umi, {}, 1)) - 1)"
_P = {b: "(" + " + ".join(_V.format(i) for i in p) + ") % 4" for b, p in {1: (1, 3, 5, 7), 2: (2, 3, 6, 7), 4: (4, 5, 6, 7), 8: range(1, 9)}.items()}


@query(
    f"""WITH {SQL_MOL}, u AS (SELECT DISTINCT umi FROM mol WHERE regexp_full_match(umi, '[ACGT]{{8}}')),
p AS (SELECT umi, {_P[1]} AS a, {_P[2]} AS b, {_P[4]} AS c, {_P[8]} AS d FROM u),
e AS (SELECT umi, greatest(a, b, c, d) AS size, CASE WHEN (a > 0)::INT + 2 * (b > 0)::INT + 4 * (c > 0)::INT = 0 THEN 8 ELSE (a > 0)::INT + 2 * (b > 0)::INT + 4 * (c > 0)::INT END AS place FROM p)
SELECT umi, CASE WHEN size = 0 THEN umi ELSE substr(umi, 1, place - 1) || substr('ACGT', ((strpos('ACGT', substr(umi, place, 1)) - 1 - size + 4) % 4 + 1)::INT, 1) || substr(umi, place + 1) END AS repaired FROM e"""
)
def r08_checksum_repair(spark, sf):
    u = molecules(spark, sf).select("umi").filter(F.col("umi").rlike("^[ACGT]{8}$")).distinct()
    return u.select("umi", rd.repair_checksum(F.col("umi")).alias("repaired"))


@query(f"WITH {SQL_READS} SELECT read_id, substr(r1_seq, 9, 8) AS umi, length(substr(r1_seq, 17, 15)) - length(replace(substr(r1_seq, 17, 15), 'T', '')) > 5 AS poly_t FROM reads")
def r09_plate_reads(spark, sf):
    r = reads(spark, sf)
    return r.select("read_id", F.substring("r1_seq", 9, 8).alias("umi"), (rd.count_of(F.substring("r1_seq", 17, 15), "T") > 5).alias("poly_t"))


@query(f"WITH {SQL_MOL} SELECT DISTINCT cell, (split_part(cell, '-', 1)::BIGINT - 1) * 9216 + (split_part(cell, '-', 2)::BIGINT - 1) * 96 + split_part(cell, '-', 3)::BIGINT AS cell_index FROM mol")
def r10_label_to_index(spark, sf):
    return molecules(spark, sf).select("cell", labels.label_to_index(F.col("cell")).alias("cell_index")).distinct()


_KIND = "CASE WHEN target LIKE '%stAbO' THEN 'tag' WHEN target LIKE '%pAbO' THEN 'protein' WHEN target LIKE '%VDJ' THEN 'receptor' ELSE 'mRNA' END"
_M = "coalesce(list_sum([x::INTEGER for x in regexp_extract_all(cigar, '([0-9]+)M', 1)]), 0)"


@query(f"WITH {SQL_READS} SELECT {_KIND} AS kind, count(*) AS n_reads FROM reads GROUP BY 1")
def r11_reference_kind(spark, sf):
    return reads(spark, sf).groupBy(rd.reference_kind(F.col("target")).alias("kind")).agg(F.count(F.lit(1)).alias("n_reads"))


@query(f"WITH {SQL_READS} SELECT cigar, {_M}::BIGINT AS matched, count(*) AS n_reads FROM reads GROUP BY 1, 2")
def r12_cigar_length(spark, sf):
    return reads(spark, sf).groupBy("cigar", rd.matched_length(F.col("cigar")).cast("bigint").alias("matched")).agg(F.count(F.lit(1)).alias("n_reads"))


_LEN = f"CASE {_KIND} WHEN 'tag' THEN {_M} >= 40 WHEN 'protein' THEN {_M} >= 25 WHEN 'receptor' THEN true ELSE {_M} >= 37 END"
_START = f"CASE {_KIND} WHEN 'tag' THEN position > 0 AND position <= 29 WHEN 'protein' THEN position > 0 AND position <= 15 WHEN 'receptor' THEN true ELSE position > 0 AND position <= 5 END"


def _placed(spark, sf):
    r = reads(spark, sf)
    kind, matched = rd.reference_kind(F.col("target")), rd.matched_length(F.col("cigar"))
    return r.select("*", kind.alias("kind"), rd.length_passes(kind, matched).alias("length_ok"), rd.start_passes(kind, F.col("position")).alias("start_ok"))


@query(f"WITH {SQL_READS} SELECT {_KIND} AS kind, {_LEN} AS length_ok, count(*) AS n_reads FROM reads GROUP BY 1, 2")
def r13_length_check(spark, sf):
    return _placed(spark, sf).groupBy("kind", "length_ok").agg(F.count(F.lit(1)).alias("n_reads"))


@query(f"WITH {SQL_READS} SELECT {_KIND} AS kind, {_START} AS start_ok, count(*) AS n_reads FROM reads GROUP BY 1, 2")
def r14_start_check(spark, sf):
    return _placed(spark, sf).groupBy("kind", "start_ok").agg(F.count(F.lit(1)).alias("n_reads"))


@query(f"WITH {SQL_READS} SELECT read_id, substr(r2_seq, 1, 12) AS ab_umi FROM reads WHERE target LIKE '%pAbO'")
def r15_protein_umi(spark, sf):
    return reads(spark, sf).filter(F.endswith("target", F.lit("pAbO"))).select("read_id", rd.protein_umi(F.col("r2_seq")).alias("ab_umi"))


@query(
    """WITH h AS (SELECT trim(sequence_id) AS read, gene, e_value FROM pyir_hits WHERE trim(sequence_id) <> ''),
g AS (SELECT read, count(*) AS nh, count(DISTINCT gene) FILTER (gene IS NOT NULL AND trim(gene) <> '') AS n_genes FROM h GROUP BY read)
SELECT read, CASE WHEN n_genes = 0 THEN 'no_feature' WHEN nh = 1 THEN '1' WHEN n_genes = 1 THEN 'MAcorrected' ELSE 'alignment_not_unique' END AS status FROM g"""
)
def r16_status_of_read(spark, sf):
    h = read(spark, sf, "pyir_hits").select(F.trim("sequence_id").alias("read"), F.when(F.trim("gene") != "", F.col("gene")).alias("gene")).filter("read != ''")
    return ro.status_of_reads(h, "read", "gene")


@query(
    f"""WITH {SQL_READS} SELECT library, position, string_agg(DISTINCT target, '|' ORDER BY target) AS transcripts,
  coalesce(avg(CASE WHEN length(r2_seq) * 20 < 1000 THEN length(r2_seq) * 20 END), avg(length(r2_seq) * 20)) AS mean_fragment FROM reads WHERE target LIKE '%VDJ' GROUP BY library, position"""
)
def r17_transcript_summary(spark, sf):
    r = reads(spark, sf).filter(F.endswith("target", F.lit("VDJ")))
    return ro.transcript_summary(r, ["library", "position"], "target", F.length("r2_seq") * 20)


@query(f"WITH {SQL_READS} SELECT read_id, 1000 + library[4:4]::INTEGER - position AS distance FROM reads WHERE is_control")
def r18_control_distance(spark, sf):
    dim = spark.createDataFrame([(f"lib{i}", 1000 + i) for i in range(1, 6)], "library string, length int")
    return joins.lookup(reads(spark, sf).filter("is_control"), dim, ["library"]).select("read_id", rd.control_distance(F.col("length"), F.col("position")).alias("distance"))


_FEATURES = """f AS (SELECT l_suppkey AS chrom, l_orderkey || '-' || l_linenumber AS feature, datediff('day', DATE '1992-01-01', l_shipdate::DATE) AS f_start,
  datediff('day', DATE '1992-01-01', l_shipdate::DATE) + l_quantity::INTEGER % 4 AS f_end, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS f_strand,
  CASE WHEN l_returnflag = 'N' THEN 'exon' ELSE 'intron' END AS kind FROM lineitem),
b AS (SELECT o_orderkey AS read, o_custkey % 100 + 1 AS chrom, CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '+' END AS strand,
  datediff('day', DATE '1992-01-01', o_orderdate::DATE) AS s, datediff('day', DATE '1992-01-01', o_orderdate::DATE) + 5 AS e FROM orders)"""


def _blocks_features(spark, sf):
    day = lambda c: F.datediff(F.col(c).cast("date"), F.lit("1992-01-01").cast("date"))
    li = read(spark, sf, "lineitem")
    f = li.select(
        F.col("l_suppkey").alias("chrom"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("feature"),
        day("l_shipdate").alias("f_start"),
        (day("l_shipdate") + F.col("l_quantity").cast("int") % 4).alias("f_end"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("f_strand"),
        F.when(F.col("l_returnflag") == "N", "exon").otherwise("intron").alias("kind"),
    )
    o = read(spark, sf, "orders")
    b = o.select(F.col("o_orderkey").alias("read"), (F.col("o_custkey") % 100 + 1).alias("chrom"), F.when(F.col("o_orderstatus") == "F", "-").otherwise("+").alias("strand"), day("o_orderdate").alias("start"), (day("o_orderdate") + 5).alias("end"))
    return b, f


@query(
    f"""WITH {_FEATURES}, m AS (SELECT read, feature, CASE WHEN strand = f_strand AND kind = 'exon' THEN 1 WHEN strand = f_strand THEN 2 WHEN kind = 'exon' THEN 3 ELSE 4 END AS tier
  FROM b JOIN f ON b.chrom = f.chrom AND s <= f_end AND f_start <= e),
t AS (SELECT read, min(tier) AS tier FROM m GROUP BY read),
n AS (SELECT m.read, t.tier, count(DISTINCT feature) AS n, min(feature) AS feature FROM m JOIN t ON m.read = t.read AND m.tier = t.tier GROUP BY m.read, t.tier)
SELECT b.read, coalesce(CASE WHEN n.n > 1 THEN 'ambiguous' ELSE n.feature END, 'no_feature') AS feature, coalesce(n.tier, 5)::INTEGER AS tier FROM b LEFT JOIN n ON b.read = n.read"""
)
def r19_feature_assignment(spark, sf):
    return joins.assign_features(*_blocks_features(spark, sf), "read", width=8)


@query(f"WITH {_FEATURES} SELECT read, feature FROM b JOIN f ON b.chrom = f.chrom AND s <= f_end AND f_start <= e")
def j14_overlap_join(spark, sf):
    b, f = _blocks_features(spark, sf)
    return joins.overlap_join(b, f, ["chrom"], 8).select("read", "feature")


_UMI_OK = "coalesce(length(umi) > 0 AND umi NOT LIKE '%N%' AND length(umi) % 12 IN (0, 8), false)"


@query(f"SELECT length(umi) AS size, {_UMI_OK} AS valid, count(*) AS n FROM molecule GROUP BY 1, 2")
def r20_umi_validity(spark, sf):
    m = read(spark, sf, "molecule")
    return m.groupBy(F.length("umi").cast("bigint").alias("size"), rd.umi_is_valid(F.col("umi")).alias("valid")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""SELECT mol_id, loaded_at, coalesce(cell_label NOT LIKE '%x%' AND raw_reads > 1 AND {_UMI_OK}, false) AS r1_valid,
  coalesce(rsec_reads > 0 AND dbec_reads > 0, false) AND NOT coalesce(gene = '*', false) AS r2_valid FROM molecule"""
)
def r21_read_validity(spark, sf):
    m = read(spark, sf, "molecule")
    r1 = rd.r1_is_valid(F.col("cell_label"), F.col("raw_reads") > 1, F.col("umi"))
    return m.select("mol_id", "loaded_at", r1.alias("r1_valid"), rd.r2_is_valid(F.col("rsec_reads") > 0, F.col("dbec_reads") > 0, F.col("gene") == "*").alias("r2_valid"))


_ALN = "CASE WHEN status = '1' OR status LIKE '%MAcorrected%' THEN 'mapped' WHEN status LIKE 'alignment%' THEN 'not_unique' WHEN status LIKE 'ambiguous%' THEN 'ambiguous' WHEN status = 'x' THEN 'not_aligned' ELSE 'no_feature' END"


@query(f"WITH {SQL_READS} SELECT library, {_ALN} AS alignment, count(*) AS n_reads FROM reads GROUP BY 1, 2")
def r22_alignment_type(spark, sf):
    return reads(spark, sf).groupBy("library", rd.alignment_type(F.col("status")).alias("alignment")).agg(F.count(F.lit(1)).alias("n_reads"))


@query(f"WITH {SQL_READS} SELECT CASE {_KIND} WHEN 'tag' THEN 'tag' WHEN 'receptor' THEN substr(split_part(target, '|', 2), 1, 1) || 'CR' ELSE 'gene' END AS route, count(*) AS n_reads FROM reads WHERE NOT is_control GROUP BY 1")
def r23_routing(spark, sf):
    kind = rd.reference_kind(F.col("target"))
    route = F.when(kind == "tag", "tag").when(kind == "receptor", F.concat(F.substring(F.split_part("target", F.lit("|"), F.lit(2)), 1, 1), F.lit("CR"))).otherwise("gene")
    return reads(spark, sf).filter("NOT is_control").groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("n_reads"))


@query("SELECT m.mol_id, m.loaded_at, coalesce(n.gene, m.target) AS gene, m.target FROM molecule m LEFT JOIN (SELECT target, min(gene) AS gene FROM molecule WHERE target IS NOT NULL GROUP BY target HAVING count(*) > 20) n ON m.target = n.target")
def r24_target_to_gene(spark, sf):
    m = read(spark, sf, "molecule").select("mol_id", "loaded_at", "target", "gene")
    names = m.filter("target IS NOT NULL").groupBy("target").agg(F.min("gene").alias("gene"), F.count(F.lit(1)).alias("n")).filter("n > 20").drop("n")
    return joins.lookup(m.drop("gene"), names, ["target"], {"gene": F.col("target")}).select("mol_id", "loaded_at", "gene", "target")


@query(
    f"""WITH {SQL_READS} SELECT {_KIND} AS kind, CASE {_KIND} WHEN 'tag' THEN {_M} >= 40 WHEN 'protein' THEN {_M} >= 30 WHEN 'receptor' THEN true ELSE {_M} > 60 END
  AND CASE WHEN {_KIND} = 'mRNA' THEN position BETWEEN 1 AND 5 ELSE {_START} END AS valid, count(*) AS n_reads FROM reads GROUP BY 1, 2"""
)
def r25_older_thresholds(spark, sf):
    kind, matched = rd.reference_kind(F.col("target")), rd.matched_length(F.col("cigar"))
    ok = rd.older_length_passes(kind, matched) & rd.older_start_passes(kind, F.col("position"))
    return reads(spark, sf).groupBy(kind.alias("kind"), ok.alias("valid")).agg(F.count(F.lit(1)).alias("n_reads"))


@query(f"WITH {SQL_READS} SELECT split_part(split_part(target, '|', 1), ':', 1) || CASE WHEN target LIKE '%pAbO' THEN '{rd.PROTEIN_MARK}' ELSE '' END AS gene, sum(position)::BIGINT AS total FROM reads GROUP BY 1")
def r26_plain_gene_names(spark, sf):
    return reads(spark, sf).groupBy(rd.plain_gene_name(F.col("target")).alias("gene")).agg(F.sum("position").alias("total"))


@query("SELECT DISTINCT gene, regexp_replace(trim(gene), '(\\*[0-9]+)D$', '\\1') AS plain FROM pyir_hits WHERE gene IS NOT NULL")
def r27_version_rewrite(spark, sf):
    g = read(spark, sf, "pyir_hits").filter("gene IS NOT NULL").select("gene").distinct()
    return g.select("gene", F.regexp_replace(F.trim("gene"), r"(?<=\*[0-9]{1,9})D$", "").alias("plain"))


@query("SELECT p_partkey, try_cast(split_part(p_size || '/' || (p_partkey % 5), '/', 1) AS DOUBLE) / nullif(try_cast(split_part(p_size || '/' || (p_partkey % 5), '/', 2) AS DOUBLE), 0) AS ratio FROM part")
def r28_ratio_parse(spark, sf):
    p = read(spark, sf, "part")
    return p.select("p_partkey", rd.ratio(F.concat_ws("/", "p_size", F.col("p_partkey") % 5)).alias("ratio"))


@query(
    """SELECT doc_id, regexp_extract(sample_name, '^([0-9]+)DPT', 1) AS time, replace(sample_name, 'DPT', '') AS removed, split_part(sample_name, '-', 2) AS treatment,
  trim(lower(source)) AS source, substr(sample_name, 1, 4) AS head, contains(sample_name, 'SHAM') AS is_sham FROM documents"""
)
def r29_string_scalars(spark, sf):
    d = read(spark, sf, "documents")
    s = F.col("sample_name")
    return d.select("doc_id", F.regexp_extract(s, "^([0-9]+)DPT", 1).alias("time"), F.replace(s, F.lit("DPT"), F.lit("")).alias("removed"), F.split_part(s, F.lit("-"), F.lit(2)).alias("treatment"), F.trim(F.lower("source")).alias("source"), F.substring(s, 1, 4).alias("head"), F.contains(s, F.lit("SHAM")).alias("is_sham"))


@query("SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'zero' WHEN 1 THEN 'one' ELSE 'other' END AS word, CASE WHEN n_nationkey < 10 THEN 'low' ELSE 'high' END AS half FROM nation")
def r30_recode(spark, sf):
    n = read(spark, sf, "nation")
    return n.select("n_nationkey", rd.recode(F.col("n_regionkey"), {0: "zero", 1: "one"}, F.lit("other")).alias("word"), F.when(F.col("n_nationkey") < 10, "low").otherwise("high").alias("half"))


@query("SELECT doc_id, split_part(sample_name, '-', 1) AS time, split_part(sample_name, '-', 2) AS treatment, split_part(sample_name, '-', 3) AS replicate FROM documents WHERE sample_name IS NOT NULL")
def r31_separate(spark, sf):
    d = read(spark, sf, "documents").filter("sample_name IS NOT NULL")
    return d.select("doc_id", *rd.separate(F.col("sample_name"), "-", ["time", "treatment", "replicate"]))


@query("SELECT p_partkey, round(log10(p_retailprice + 1), 9) AS a, round(ln(p_size + 1), 9) AS b, round(pow(10.0, p_size / 25.0), 6) AS c, CASE WHEN p_size % 3 = 0 THEN 0.0 ELSE p_size / (p_size % 3) END AS d FROM part")
def r32_math_scalars(spark, sf):
    p = read(spark, sf, "part")
    size = F.col("p_size").cast("double")
    d = rd.finite(F.try_divide(size, F.col("p_size") % 3))
    return p.select("p_partkey", F.round(F.log10(F.col("p_retailprice") + 1), 9).alias("a"), F.round(F.log1p(size), 9).alias("b"), F.round(F.pow(F.lit(10.0), size / 25), 6).alias("c"), d.alias("d"))


# ---------------------------------------------------------------- molecules


@query(
    """SELECT gene, cell, umi, count(*) AS raw_reads FROM (SELECT l_partkey::VARCHAR AS gene, l_suppkey AS cell, translate(substr(md5(l_orderkey::VARCHAR), 1, 4), '0123456789abcdef', 'ACGTACGTACGTACGT') AS umi FROM lineitem) GROUP BY ALL"""
)
def m01_reads_per_molecule(spark, sf):
    li = read(spark, sf, "lineitem")
    rows = li.select(F.col("l_partkey").cast("string").alias("gene"), F.col("l_suppkey").alias("cell"), F.translate(F.substring(F.md5(F.col("l_orderkey").cast("string")), 1, 4), "0123456789abcdef", "ACGTACGTACGTACGT").alias("umi"))
    return mo.reads_per_molecule(rows)


@query()
def m02_substitution_correction(spark, sf):
    return mo.correct_substitutions(molecules(spark, sf), ["cell", "gene"])


@query(f"WITH {SQL_MOL} SELECT cell, gene, sum(raw_reads)::BIGINT AS reads FROM mol WHERE umi IS NOT NULL AND raw_reads IS NOT NULL GROUP BY cell, gene")
def m02_reads_are_kept(spark, sf):
    return m02_substitution_correction(spark, sf).groupBy("cell", "gene").agg(F.sum("rsec_reads").alias("reads"))


@query(f"WITH {SQL_MOL}, u AS (SELECT DISTINCT cell, gene, umi FROM mol WHERE umi IS NOT NULL) SELECT a.cell, a.gene, a.umi AS umi_a, b.umi AS umi_b FROM u a JOIN u b ON a.cell = b.cell AND a.gene = b.gene AND length(a.umi) = length(b.umi) AND a.umi < b.umi WHERE hamming(a.umi, b.umi) <= 1")
def j16_umi_neighbours(spark, sf):
    return mo.neighbour_pairs(molecules(spark, sf).filter("umi IS NOT NULL"), ["cell", "gene"])


@query(f"WITH {SQL_MOL} SELECT mol_id, CASE WHEN gene LIKE '%1' THEN raw_reads ELSE rsec_reads END AS rsec_reads, CASE WHEN gene LIKE '%1' THEN NULL ELSE corrected_umi END AS parent_umi FROM mol")
def m03_tag_bypass(spark, sf):
    m = molecules(spark, sf)
    return m.select("mol_id", *[c.alias(k) for k, c in ro.without_correction(m, F.endswith("gene", F.lit("1"))).items()])


@query(
    f"""WITH {SQL_MOL} SELECT gene, count(*) AS molecules, sum(rsec_reads)::BIGINT AS reads, count(*) FILTER (rsec_reads = 1) AS singletons, count(*) FILTER (rsec_reads > 1) AS multi_molecules,
  sum(CASE WHEN rsec_reads > 1 THEN rsec_reads END)::BIGINT AS multi_reads, count(DISTINCT rsec_reads) AS distinct_counts,
  CASE WHEN count(*) FILTER (rsec_reads > 1) = 0 OR avg(CASE WHEN rsec_reads > 1 THEN rsec_reads END) < 4 THEN 'low_depth' WHEN count(*) FILTER (rsec_reads = 1) = 0 THEN 'no_singletons' ELSE 'fit' END AS branch
FROM mol WHERE rsec_reads > 0 GROUP BY gene"""
)
def m04_depth_branches(spark, sf):
    return mo.depth_branches(molecules(spark, sf))


@query()
def m04_depth_cutoffs(spark, sf):
    return mo.depth_cutoffs(molecules(spark, sf))


@query(
    f"""WITH {SQL_MOL}, c AS (SELECT cell, list_sort(list(rsec_reads)) AS l, count(*) AS n, count(*) / 65536.0 AS lam FROM mol WHERE rsec_reads > 0 GROUP BY cell HAVING count(*) > 40),
d AS (SELECT l, (1 - round_even((1 - exp(-lam) - lam * exp(-lam)) / (1 - exp(-lam)), 3)) * (n - 1) AS place FROM c),
e AS (SELECT l, l[floor(place)::BIGINT + 1] + (l[ceil(place)::BIGINT + 1] - l[floor(place)::BIGINT + 1]) * (place - floor(place)) AS depth FROM d)
SELECT 'all' AS all_genes, sum(len(list_filter(l, lambda x: x > depth)))::BIGINT AS doublets FROM e HAVING count(*) > 0"""
)
def m05_doublet_trim(spark, sf):
    m = molecules(spark, sf).filter("rsec_reads > 0")
    bars = m.groupBy(F.lit("all").alias("all_genes"), "cell", F.col("rsec_reads").alias("count")).agg(F.count(F.lit(1)).alias("freq"))
    return mo._doublets(bars, "all_genes", "cell", 65_536, 40)


@query(
    f"""WITH {SQL_MOL}, c AS (SELECT gene, (length(gene) + count(*)) % 4 AS cutoff FROM mol GROUP BY gene)
SELECT mol_id, CASE WHEN rsec_reads < cutoff THEN 0 ELSE rsec_reads END AS dbec_reads, CASE WHEN rsec_reads < cutoff AND rsec_reads > 0 THEN 'NNNNNNN' ELSE corrected_umi END AS corrected_umi FROM mol JOIN c USING (gene)"""
)
def m06_apply_cutoffs(spark, sf):
    m = molecules(spark, sf).drop("dbec_reads").withColumnRenamed("corrected_umi", "parent_umi")
    cut = m.groupBy("gene").agg(((F.length(F.first("gene")) + F.count(F.lit(1))) % 4).alias("cutoff"))
    return mo.apply_cutoffs(m, cut).select("mol_id", "dbec_reads", "corrected_umi")


@query("SELECT DISTINCT target, target NOT LIKE '%stAbO' AND target LIKE '%pAbO' AS whole, target NOT LIKE '%stAbO' AS targeted FROM (SELECT split_part(target, '|', 1) || CASE mol_id % 5 WHEN 0 THEN '|stAbO' WHEN 1 THEN '|pAbO' ELSE '' END AS target FROM molecule WHERE target IS NOT NULL)")
def m07_depth_correction_used(spark, sf):
    suffix = F.when(F.col("mol_id") % 5 == 0, "|stAbO").when(F.col("mol_id") % 5 == 1, "|pAbO").otherwise("")
    t = read(spark, sf, "molecule").filter("target IS NOT NULL").select(F.concat(F.substring_index("target", "|", 1), suffix).alias("target")).distinct()
    return t.select("target", mo.uses_depth_correction("WTA", F.col("target")).alias("whole"), mo.uses_depth_correction("Targeted", F.col("target")).alias("targeted"))


@query(f"WITH {SQL_MOL} SELECT cell, gene, umi, corrected_umi FROM mol WHERE length(corrected_umi) >= 8")
def m08_corrected_umis(spark, sf):
    return mo.corrected_umis(molecules(spark, sf), ["cell", "gene"])


@query(f"WITH {SQL_CELL_GENE} SELECT * FROM cell_gene")
def m09_cell_gene_counts(spark, sf):
    return cell_gene(spark, sf)


@query(f"WITH {SQL_READS} SELECT target NOT LIKE '%pAbO' AS is_mrna, count(*) AS n FROM reads GROUP BY 1")
def m10_split_by_kind(spark, sf):
    parts = mo.split_by_kind(reads(spark, sf), "target")
    return parts["mrna"].groupBy(F.lit(True).alias("is_mrna")).agg(F.count(F.lit(1)).alias("n")).unionByName(parts["protein"].groupBy(F.lit(False).alias("is_mrna")).agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- joins


@query(f"WITH {SQL_READS} SELECT a.read_id, length(a.r1_seq) AS r1, length(b.r2_seq) AS r2 FROM reads a JOIN reads b USING (read_id)")
def j01_pair_by_id(spark, sf):
    r = materialize(reads(spark, sf), "reads")
    return joins.join_by_id(r.select("read_id", F.length("r1_seq").cast("bigint").alias("r1")), r.select("read_id", F.length("r2_seq").cast("bigint").alias("r2")), "read_id")


@query(f"WITH {SQL_READS}, a AS (SELECT read_id, status FROM reads WHERE status <> 'alignment_not_unique') SELECT reads.read_id, a.status FROM reads LEFT JOIN a USING (read_id)")
def j02_primary_alignments(spark, sf):
    r = materialize(reads(spark, sf), "reads")
    return ro.primary_alignments(r, r, "read_id", F.col("status") != "alignment_not_unique", ["status"])


@query(f"WITH {SQL_MOL} SELECT mol_id, coalesce(CASE WHEN length(corrected_umi) >= 8 THEN corrected_umi END, umi) AS umi FROM mol")
def j03_corrected_umi_lookup(spark, sf):
    m = molecules(spark, sf)
    table = mo.corrected_umis(m, ["mol_id"]).drop("umi")
    return m.select("mol_id", "umi").join(table, "mol_id", "left").select("mol_id", F.coalesce("corrected_umi", "umi").alias("umi"))


@query(
    f"""WITH {SQL_CALLED}, c AS (SELECT cell, CASE cell % 5 WHEN 0 THEN 'Multiplet' WHEN 1 THEN 'Undetermined' ELSE 'SampleTag0' || (cell % 5) || '_hs' END AS tag FROM called)
SELECT m.mol_id, m.loaded_at, CASE c.tag WHEN 'Multiplet' THEN 'M' WHEN 'Undetermined' THEN 'x' ELSE regexp_extract(c.tag, '([0-9]+)', 1) END AS tag FROM molecule m LEFT JOIN c ON m.cell = c.cell"""
)
def j04_cell_to_tag(spark, sf):
    c = called_cells(spark, sf)
    tag = F.when(F.col("cell") % 5 == 0, "Multiplet").when(F.col("cell") % 5 == 1, "Undetermined").otherwise(F.concat(F.lit("SampleTag0"), F.col("cell") % 5, F.lit("_hs")))
    short = F.when(F.col("tag") == "Multiplet", "M").when(F.col("tag") == "Undetermined", "x").otherwise(F.regexp_extract("tag", "([0-9]+)", 1))
    calls = c.select("cell", tag.alias("tag")).select("cell", short.alias("tag"))
    return joins.lookup(read(spark, sf, "molecule").select("mol_id", "loaded_at", "cell"), calls, ["cell"]).select("mol_id", "loaded_at", "tag")


@query("SELECT h.sequence_id, h.gene, h.loaded_at, s.n_hits FROM pyir_hits h LEFT JOIN (SELECT sequence_id, count(*) AS n_hits FROM pyir_hits WHERE e_value < 1e-10 GROUP BY 1) s ON h.sequence_id = s.sequence_id")
def j05_summary_lookup(spark, sf):
    h = read(spark, sf, "pyir_hits")
    s = h.filter("e_value < 1e-10").groupBy("sequence_id").agg(F.count(F.lit(1)).alias("n_hits"))
    return joins.lookup(h.select("sequence_id", "gene", "loaded_at"), s, ["sequence_id"])


@query(f"WITH {SQL_CALLED} SELECT cell IN (SELECT cell FROM called) AS is_called, count(*) AS n FROM molecule WHERE cell IS NOT NULL GROUP BY 1")
def j06_semi_and_anti(spark, sf):
    m, c = read(spark, sf, "molecule").filter("cell IS NOT NULL").select("cell"), called_cells(spark, sf)
    n = lambda how, v: m.join(joins.sized_broadcast(c), "cell", how).groupBy(F.lit(v).alias("is_called")).agg(F.count(F.lit(1)).alias("n"))
    return n("left_semi", True).unionByName(n("left_anti", False))


@query("SELECT o.o_orderkey, c.n, c.total FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS total FROM lineitem GROUP BY 1) c ON o.o_orderkey = c.l_orderkey")
def j07_counts_per_parent(spark, sf):
    c = read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("total"))
    return joins.to_domain(c, read(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], {})


@query(f"WITH {SQL_CALLED}, {SQL_MOL} SELECT DISTINCT mol.cell, coalesce(called.algorithm, 'Unknown') AS kind FROM mol LEFT JOIN called ON called.cell = (split_part(mol.cell, '-', 1)::BIGINT - 1) * 9216 + (split_part(mol.cell, '-', 2)::BIGINT - 1) * 96 + split_part(mol.cell, '-', 3)::BIGINT")
def j08_type_or_unknown(spark, sf):
    m = molecules(spark, sf).select("cell").distinct().withColumn("index", labels.label_to_index(F.col("cell")))
    c = called_cells(spark, sf).select(F.col("cell").cast("bigint").alias("index"), F.col("algorithm").alias("kind"))
    return joins.lookup(m, c, ["index"], {"kind": F.lit("Unknown")}).select("cell", "kind")


@query("SELECT n.n_name, r.r_name FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey")
def j09_code_to_category(spark, sf):
    r = read(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return joins.lookup(read(spark, sf, "nation"), r, ["n_regionkey"]).select("n_name", "r_name")


@query(f"WITH {SQL_CALLED}, m AS (SELECT cell, count(*) AS n FROM molecule GROUP BY cell) SELECT called.cell, coalesce(m.n, 0) AS n FROM called LEFT JOIN m USING (cell)")
def j10_to_domain(spark, sf):
    n = read(spark, sf, "molecule").groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    return joins.to_domain(n, called_cells(spark, sf).select("cell"), ["cell"], {"n": 0})


@query("SELECT coalesce(a.cell, b.cell) AS cell, coalesce(a.n, 0) AS n, coalesce(b.m, 0) AS m FROM (SELECT cell, count(*) AS n FROM molecule WHERE cell IS NOT NULL GROUP BY 1) a FULL JOIN (SELECT cell, count(*) AS m FROM sample_tag_cell WHERE cell IS NOT NULL GROUP BY 1) b ON a.cell = b.cell")
def j11_outer_index_join(spark, sf):
    a = read(spark, sf, "molecule").filter("cell IS NOT NULL").groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    b = read(spark, sf, "sample_tag_cell").filter("cell IS NOT NULL").groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
    return joins.outer_join_all([a, b], ["cell"])


@query(f"WITH {SQL_READS}, a AS (SELECT library, count(*) AS n FROM reads GROUP BY 1), b AS (SELECT library, count(*) AS mapped FROM reads WHERE status = '1' GROUP BY 1) SELECT library, n, mapped FROM a JOIN b USING (library)")
def j12_sections_by_library(spark, sf):
    return ro.counts_and_part(reads(spark, sf), "library", F.col("status") == "1", "mapped")


@query("SELECT c.c_custkey, n.n_name, r.r_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey")
def j13_left_join_chain(spark, sf):
    n = read(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    r = read(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return joins.lookup(joins.lookup(read(spark, sf, "customer"), n, ["c_nationkey"]), r, ["n_regionkey"]).select("c_custkey", "n_name", "r_name")


@query("SELECT DISTINCT a.n_name AS key_a, b.n_name AS key_b FROM nation a, nation b WHERE a.n_name < b.n_name")
def j17_all_pairs_of_few(spark, sf):
    return joins.pairs_of(read(spark, sf, "nation"), "n_name")
