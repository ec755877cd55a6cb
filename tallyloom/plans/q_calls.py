"""Queries of cell calling (C), tag calling (T) and receptors (V), with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import digest_number, sql_strip, strip
from ..operators import cells as ce, receptors as re_, shred, tags as tg, windows as wi
from ..operators.wide import attributes_of
from ..session import materialize
from .bindings import HEX, LETTERS, SQL_CALLED, SQL_CELL_GENE, SQL_TAGS, called_cells, cell_gene, tag_counts
from .problems import SQL_RECORDS, _tag_rows
from .registry_helpers import book
from .tables import read

QUERIES, SQL, query = book()


# ---------------------------------------------------------------- cells


def _totals(spark, sf):
    return cell_gene(spark, sf).groupBy("cell").agg(F.sum("dbec_reads").alias("total"))


@query()
def c01_cells_by_mode(spark, sf):
    """The cells of most reads, at the number that the curve tells, or 100 where it tells none."""
    t = materialize(_totals(spark, sf), "totals")
    n = ce.count_cells(t, "total") or 100
    return ce.top_cells(t, "cell", "total", n)


@query()
def c02_cell_number(spark, sf):
    t = _totals(spark, sf)
    return spark.createDataFrame([(ce.count_cells(t, "total"), ce.count_cells(t, "total", 100))], "cells int, cells_near_100 int")


@query(f"WITH {SQL_CELL_GENE} SELECT cell FROM (SELECT cell, row_number() OVER (ORDER BY sum(dbec_reads) DESC, cell) AS k FROM cell_gene GROUP BY cell) WHERE k <= 150")
def c03_top_cells(spark, sf):
    return ce.top_cells(_totals(spark, sf), "cell", "total", 150)


def _with_knee(spark, sf):
    """The lab's table with a knee, which it lacks itself: about every seventh label, by digest, has 50 times the reads and molecules."""
    x = materialize(cell_gene(spark, sf), "cell-genes")
    is_cell = F.pmod(digest_number("cell", seed=3), F.lit(7)) == 0
    return x.withColumns({c: F.when(is_cell, F.col(c) * 50).otherwise(F.col(c)) for c in ("dbec_reads", "dbec_mols")})


@query()
def c04_refined_cells(spark, sf):
    return ce.call_cells(_with_knee(spark, sf), 1000, "WTA")


@query()
def c05_refined_targeted(spark, sf):
    return ce.call_cells(_with_knee(spark, sf), 1000, "Targeted")


@query(
    f"""WITH {SQL_CELL_GENE}, t AS (SELECT cell, sum(dbec_mols)::BIGINT AS v FROM cell_gene GROUP BY cell), r AS (SELECT *, row_number() OVER w AS k, count(*) OVER () AS n, lead(v) OVER w AS after FROM t WINDOW w AS (ORDER BY v DESC, cell)),
q AS (SELECT v AS cutoff, v - after AS jump FROM r WHERE k > n - ceil(n / 4) AND after IS NOT NULL ORDER BY after - v, k LIMIT 1), c AS (SELECT CASE WHEN (avg((v < cutoff)::INT) > 0.2 AND any_value(jump) < 500) OR any_value(jump) = 1 THEN 20 ELSE any_value(cutoff) END AS cutoff FROM t, q)
SELECT cell FROM t, c WHERE v >= cutoff"""
)
def c06_low_molecule_cleanup(spark, sf):
    t = materialize(cell_gene(spark, sf).groupBy("cell").agg(F.sum("dbec_mols").alias("v")), "mols")
    d = wi.largest_drop(t, "v", "cell").first()
    share = t.agg(F.avg((F.col("v") < d["cutoff"]).cast("int"))).first()[0]
    cutoff = 20 if (share > 0.2 and d["jump"] < 500) or d["jump"] == 1 else d["cutoff"]
    return t.filter(F.col("v") >= cutoff).select("cell")


@query(
    f"""WITH {SQL_CELL_GENE}, t AS (SELECT cell, sum(dbec_reads)::BIGINT AS total, row_number() OVER (ORDER BY sum(dbec_reads) DESC, cell) AS k FROM cell_gene GROUP BY cell)
SELECT CASE WHEN k <= 50 THEN 'cell' ELSE 'noise' END AS "class", count(*) AS n, sum(total)::BIGINT AS reads, avg(total) AS mean, median(total) AS median, 100.0 * sum(total) / sum(sum(total)) OVER () AS pct_reads FROM t GROUP BY 1"""
)
def c07_label_statistics(spark, sf):
    t = _totals(spark, sf)
    return ce.label_statistics(t, ce.top_cells(t, "cell", "total", 50), "cell", "total")


@query(f"WITH {SQL_CALLED} SELECT coalesce(algorithm, '-') AS algorithm, count(*) AS n FROM called GROUP BY 1")
def c07_origin_of_cells(spark, sf):
    return called_cells(spark, sf).groupBy(F.coalesce("algorithm", F.lit("-")).alias("algorithm")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 0 AS cells")
def c08_too_few_points(spark, sf):
    few = read(spark, sf, "nation").select(F.col("n_name").alias("cell"), F.col("n_nationkey").alias("total"))
    return spark.createDataFrame([(ce.count_cells(few, "total"),)], "cells int")


# ---------------------------------------------------------------- sample tags


def _counts(spark, sf):
    return tag_counts(spark, sf).select("cell", "tag", F.col("reads").cast("bigint").alias("n"))


def _domain(spark, sf):
    return tag_counts(spark, sf).select("cell").distinct()


@query(f"WITH {SQL_TAGS}, {SQL_CALLED} SELECT c.cell, t.tag, coalesce(tags.reads, 0) AS n FROM called c CROSS JOIN (SELECT DISTINCT tag FROM tags) t LEFT JOIN tags ON tags.cell = c.cell AND tags.tag = t.tag")
def t01_zero_filled_counts(spark, sf):
    c = _counts(spark, sf)
    names = attributes_of(c.select(F.col("tag").alias("attribute")), 1000)
    domain = called_cells(spark, sf).select("cell").withColumn("tag", F.explode(F.array(*[F.lit(x) for x in names])))
    return domain.join(c, ["cell", "tag"], "left").fillna(0)


_T = f"""{SQL_TAGS}, c AS (SELECT cell, tag, reads AS n FROM tags),
p AS (SELECT cell, sum(n)::BIGINT AS total, max(n) AS top_n, min_by(tag, (-n, tag)) AS top_tag FROM c GROUP BY cell), mk AS (SELECT c.*, p.* EXCLUDE cell, top_n > 0.75 * total AND top_n >= 30 AS is_good FROM c JOIN p USING (cell)),
n0 AS (SELECT tag, n FROM mk WHERE is_good AND tag <> top_tag AND n > 0), n1 AS (SELECT tag, median(n) AS m FROM n0 GROUP BY tag), n2 AS (SELECT n0.tag, n, abs(n - m) AS d FROM n0 JOIN n1 USING (tag)), n3 AS (SELECT tag, median(d) AS s FROM n2 GROUP BY tag),
noise AS (SELECT n2.tag, n FROM n2 JOIN n3 USING (tag) WHERE d / (CASE WHEN s = 0 THEN 1 ELSE s END) < 12)"""
_T4 = f"""{_T}, g0 AS (SELECT tag, n FROM mk WHERE is_good AND tag = top_tag), g1 AS (SELECT tag, n FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY n) AS k FROM g0) WHERE k <= 100), g2 AS (SELECT tag, median(n) AS m FROM g1 GROUP BY tag),
g3 AS (SELECT g1.tag, n, abs(n - m) AS d FROM g1 JOIN g2 USING (tag)), g4 AS (SELECT tag, median(d) AS s FROM g3 GROUP BY tag), g5 AS (SELECT g3.tag, min(n) * 0.75 AS low FROM g3 JOIN g4 USING (tag) WHERE d / (CASE WHEN s = 0 THEN 1 ELSE s END) < 4 GROUP BY g3.tag),
th AS (SELECT g5.tag, (SELECT count(*) FROM g0 WHERE g0.tag = g5.tag) AS n_good, (CASE WHEN low < x.top THEN x.top * 1.5 ELSE low END)::DOUBLE AS min_good FROM g5 LEFT JOIN (SELECT tag, max(n) AS top FROM noise GROUP BY tag) x USING (tag))"""
_T5 = f"{_T4}, sh AS (SELECT noise.tag, sum(n) / sum(sum(n)) OVER () AS noise_share FROM noise JOIN th USING (tag) WHERE n < min_good GROUP BY noise.tag), sl AS (SELECT coalesce(sum(total * (total - top_n)) / sum(total * total), 0) AS slope FROM (SELECT DISTINCT cell, total, top_n FROM mk WHERE is_good))"


@query(f"WITH {_T} SELECT DISTINCT cell, top_tag, top_n, total FROM mk WHERE is_good")
def t02_good_singletons(spark, sf):
    return tg.singletons(_counts(spark, sf)).filter("is_good").select("cell", "top_tag", "top_n", "total").distinct()


@query(f"WITH {_T} SELECT tag, count(*) AS n, max(n)::BIGINT AS top FROM noise GROUP BY tag")
def t03_noise_counts(spark, sf):
    return tg.noise_counts(tg.singletons(_counts(spark, sf))).groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.max("n").alias("top"))


@query(f"WITH {_T4} SELECT tag, n_good, min_good FROM th")
def t04_good_thresholds(spark, sf):
    m = tg.singletons(_counts(spark, sf))
    return tg.good_thresholds(m, tg.noise_counts(m)).withColumn("min_good", F.col("min_good").cast("double"))


@query(f"WITH {_T5} SELECT tag, noise_share FROM sh")
def t05_noise_shares(spark, sf):
    m = tg.singletons(_counts(spark, sf))
    n = tg.noise_counts(m)
    return tg.noise_shares(n, tg.good_thresholds(m, n))


@query(f"WITH {_T5} SELECT slope FROM sl")
def t06_noise_slope(spark, sf):
    return spark.createDataFrame([(tg.noise_slope(tg.singletons(_counts(spark, sf))),)], "slope double")


@query(
    f"""WITH {_T5}, k AS (SELECT mk.cell, mk.tag, greatest(n - round_even(coalesce(noise_share, 0) * slope * total, 0), 0) AS c, min_good FROM mk JOIN th USING (tag) LEFT JOIN sh USING (tag), sl),
h AS (SELECT cell, list(tag ORDER BY tag) FILTER (c >= min_good) AS hits, min_by(tag, (-c / min_good, tag)) FILTER (c >= 5 AND c / min_good > 0.2) AS best FROM k GROUP BY cell),
t AS (SELECT d.cell, CASE WHEN len(hits) > 0 THEN hits WHEN best IS NOT NULL THEN [best] ELSE [] END AS t FROM (SELECT DISTINCT cell FROM tags) d LEFT JOIN h USING (cell))
SELECT cell, CASE WHEN len(t) = 0 THEN 'Undetermined' WHEN len(t) > 1 THEN 'Multiplet' ELSE t[1] END AS sample_tag, array_to_string(t, ';') AS tags FROM t"""
)
def t07_call_tags(spark, sf):
    return tg.call_tags(_counts(spark, sf), _domain(spark, sf)).calls


@query(f"WITH {SQL_TAGS} SELECT cell, tag, split_part(tag, '_', 1) || '-' || split_part(tag, '_', 2) AS sample FROM tags WHERE reads > 0")
def t08_named_outputs(spark, sf):
    t = tag_counts(spark, sf).filter("reads > 0")
    return t.select("cell", "tag", F.concat_ws("-", F.split_part("tag", F.lit("_"), F.lit(1)), F.split_part("tag", F.lit("_"), F.lit(2))).alias("sample"))


# ---------------------------------------------------------------- receptors

_TYPES = {"IGW": "B", "IGQ": "B", "TRX": "T", "TRZ": "T"}


def _reads(spark, sf):
    """One read per sequence: its best V and J hits, and a CDR3 derived from them by digest."""
    h = read(spark, sf, "pyir_hits")
    g = strip(F.regexp_replace(strip("gene"), "^lcl[|]", ""))
    h = h.select(strip("sequence_id").alias("s"), g.alias("g"), F.col("gene_type").alias("k"), "bit_score", "e_value").filter("s != '' AND g != '' AND bit_score IS NOT NULL AND NOT isnan(bit_score) AND e_value IS NOT NULL")
    best = lambda kind: F.min(F.when(F.col("k") == kind, F.struct((-F.col("bit_score")).alias("b"), F.col("g").alias("g"), F.col("e_value").alias("e"))))
    x = h.groupBy("s").agg(best("V").alias("v"), best("J").alias("j")).filter("v IS NOT NULL AND j IS NOT NULL")
    part = lambda i: F.split_part("s", F.lit(","), F.lit(i))
    dna = F.translate(F.md5(F.concat(F.substring("v.g", 1, 5), F.substring(part(3), 1, 2))), HEX, LETTERS)
    return x.select(
        part(2).cast("int").alias("cell"),
        F.substring("v.g", 1, 3).alias("chain"),
        part(3).alias("umi"),
        F.col("v.g").alias("v_gene"),
        F.col("v.e").alias("v_e_value"),
        F.col("j.g").alias("j_gene"),
        F.col("j.e").alias("j_e_value"),
        F.substring(dna, 1, 9).alias("cdr3_nt"),
        F.translate(F.substring(dna, 1, 3), "ACGT", "KLMN").alias("cdr3_aa"),
        (F.substring(dna, 10, 1) < "G").alias("productive"),
    )


_G = sql_strip(f"regexp_replace({sql_strip('gene')}, '^lcl[|]', '')")
_VR = f"""hit AS (SELECT {sql_strip("sequence_id")} AS s, {_G} AS g, gene_type AS k, bit_score, e_value FROM pyir_hits WHERE bit_score IS NOT NULL AND NOT isnan(bit_score) AND e_value IS NOT NULL),
best AS (SELECT s, min((-bit_score, g, e_value)) FILTER (k = 'V') AS v, min((-bit_score, g, e_value)) FILTER (k = 'J') AS j FROM hit WHERE s <> '' AND g <> '' GROUP BY s),
vr0 AS (SELECT s, v[2] AS vg, v[3] AS ve, j[2] AS jg, j[3] AS je, translate(md5(substr(v[2], 1, 5) || substr(split_part(s, ',', 3), 1, 2)), '{HEX}', '{LETTERS}') AS dna FROM best WHERE v IS NOT NULL AND j IS NOT NULL),
vr AS (SELECT split_part(s, ',', 2)::INTEGER AS cell, substr(vg, 1, 3) AS chain, split_part(s, ',', 3) AS umi, vg AS v_gene, ve AS v_e_value, jg AS j_gene, je AS j_e_value, substr(dna, 1, 9) AS cdr3_nt, translate(substr(dna, 1, 3), 'ACGT', 'KLMN') AS cdr3_aa, substr(dna, 10, 1) < 'G' AS productive FROM vr0)"""


_CHAIN = f"CASE chain_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in re_.CHAIN_NAMES.items())} END"


@query(f"{SQL_RECORDS} SELECT record_id, sequence_id, {_CHAIN} AS chain, cdr3_nt AS cdr3_nucleotide, productive, sequence_length, n_hits FROM record_table WHERE is_complete")
def v01_normalised_records(spark, sf):
    return re_.normalised_records(shred.record_table(read(spark, sf, "pyir_records")))


@query(f"WITH {_VR} SELECT * FROM vr WHERE v_e_value < 1e-20 AND j_e_value < 1e-10 AND chain <> 'TRZ'")
def v02_valid_reads(spark, sf):
    return re_.valid_reads(_reads(spark, sf), 1e-20, 1e-10, ("TRZ",))


@query()
def v03_corrected_reads(spark, sf):
    return re_.correct_reads(_reads(spark, sf))


@query(f"WITH {_VR} SELECT cell, chain, count(*) AS n FROM vr GROUP BY 1, 2")
def v03_reads_are_kept(spark, sf):
    return re_.correct_reads(_reads(spark, sf)).groupBy("cell", "chain").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_VR} SELECT cdr3_nt, cdr3_aa FROM (SELECT cdr3_nt, cdr3_aa, row_number() OVER (PARTITION BY cdr3_nt ORDER BY count(*) DESC, cdr3_aa) AS k FROM vr GROUP BY 1, 2) WHERE k = 1")
def v04_modal_translation(spark, sf):
    return re_.modal_translation(_reads(spark, sf))


_UT = f"""{_VR}, cn AS (SELECT cell, chain, umi, cdr3_nt, count(*) AS n FROM vr GROUP BY ALL), ut AS (SELECT cell, chain, umi, v_gene, j_gene, cdr3_nt, cdr3_aa, productive, reads FROM (
  SELECT vr.*, count(*) OVER (PARTITION BY vr.cell, vr.chain, vr.umi) AS reads, row_number() OVER (PARTITION BY vr.cell, vr.chain, vr.umi ORDER BY n DESC, productive DESC, v_e_value NULLS LAST, cdr3_nt, v_gene, j_gene, cdr3_aa) AS k FROM vr JOIN cn USING (cell, chain, umi, cdr3_nt)) WHERE k = 1)"""
_CT = f"""{_UT}, cl AS (SELECT cell, chain, cdr3_nt, count(*) AS molecules, sum(reads)::BIGINT AS reads, min((v_gene, j_gene, cdr3_aa)) AS x FROM ut GROUP BY 1, 2, 3),
ct AS (SELECT t.*, d.cdr3_nt AS dominant, d.x[1] AS v_gene, d.x[2] AS j_gene FROM (SELECT cell, chain, sum(molecules)::BIGINT AS molecules, sum(reads)::BIGINT AS reads, count(*) AS clones FROM cl GROUP BY 1, 2) t
  JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cell, chain ORDER BY molecules DESC, reads DESC, cdr3_nt) AS k FROM cl) WHERE k = 1) d USING (cell, chain))"""
_WIDE_COLS = ", ".join(f"coalesce(sum(molecules) FILTER (chain = '{c}'), 0)::BIGINT AS {c}_molecules, coalesce(sum(reads) FILTER (chain = '{c}'), 0)::BIGINT AS {c}_reads, any_value(dominant) FILTER (chain = '{c}') AS {c}_dominant" for c in _TYPES)
_WT = f"{_CT}, wt AS (SELECT cell, {_WIDE_COLS}, sum(CASE WHEN chain IN ('IGW', 'IGQ', 'TRX', 'TRZ') THEN molecules ELSE 0 END)::BIGINT AS total_molecules, sum(CASE WHEN chain IN ('IGW', 'IGQ', 'TRX', 'TRZ') THEN reads ELSE 0 END)::BIGINT AS total_reads FROM ct GROUP BY cell)"
_TYPE = "CASE WHEN 2 * (TRX_molecules + TRZ_molecules) < IGW_molecules + IGQ_molecules THEN 'B' WHEN 2 * (IGW_molecules + IGQ_molecules) < TRX_molecules + TRZ_molecules THEN 'T' ELSE 'Unknown' END"


def _umis(spark, sf):
    return re_.umi_table(_reads(spark, sf))


def _wide(spark, sf):
    return re_.cell_table(re_.chain_table(_umis(spark, sf)), list(_TYPES))


@query(f"WITH {_UT} SELECT * FROM ut")
def v05_umi_table(spark, sf):
    return _umis(spark, sf)


@query(f"WITH {_CT} SELECT * FROM ct")
def v06_chain_table(spark, sf):
    return re_.chain_table(_umis(spark, sf))


@query(f"WITH {_WT} SELECT * FROM wt")
def v07_cell_table(spark, sf):
    return _wide(spark, sf)


@query(f"WITH {_WT} SELECT cell, {_TYPE} AS cell_type FROM wt")
def v08_cell_type(spark, sf):
    return _wide(spark, sf).select("cell", re_.cell_type(_TYPES).alias("cell_type"))


@query()
def v09_read_cutoffs(spark, sf):
    c = re_.chain_table(_umis(spark, sf))
    return re_.read_cutoffs(c, 1)


_KEEP = {c: f"(ty = '{t}' OR ty = 'Unknown')" for c, t in _TYPES.items()}


@query(
    f"WITH {_WT}, y AS (SELECT *, {_TYPE} AS ty FROM wt) SELECT cell, ty AS cell_type, "
    + ", ".join(f"CASE WHEN {_KEEP[c]} THEN {c}_{v} ELSE 0 END AS {c}_{v}" for c in _TYPES for v in ("molecules", "reads"))
    + ", "
    + ", ".join(f"CASE WHEN {_KEEP[c]} THEN {c}_dominant END AS {c}_dominant" for c in _TYPES)
    + ", "
    + ", ".join("(" + " + ".join(f"CASE WHEN {_KEEP[c]} THEN {c}_{v} ELSE 0 END" for c in _TYPES) + f") AS total_{v}" for v in ("molecules", "reads"))
    + " FROM y"
)
def v10_inconsistent_cleared(spark, sf):
    w = _wide(spark, sf).withColumn("cell_type", re_.cell_type(_TYPES))
    return re_.clear_other_types(w, _TYPES)


_FIRST = "CASE WHEN TRX_molecules > 0 AND TRZ_molecules > 0 AND NOT (IGW_molecules > 0 AND IGQ_molecules > 0) THEN true WHEN IGW_molecules > 0 AND IGQ_molecules > 0 AND NOT (TRX_molecules > 0 AND TRZ_molecules > 0) THEN false ELSE TRX_molecules + TRZ_molecules >= IGW_molecules + IGQ_molecules END"


@query(
    f"WITH {_WT} SELECT cell, "
    + ", ".join(f"CASE WHEN IGW_molecules >= IGQ_molecules THEN IGW_{v} ELSE IGQ_{v} END AS light_{v}, CASE WHEN {_FIRST} THEN TRX_{v} ELSE IGW_{v} END AS first_{v}, CASE WHEN {_FIRST} THEN TRZ_{v} ELSE IGQ_{v} END AS second_{v}" for v in ("molecules", "reads", "dominant"))
    + " FROM wt"
)
def v11_consolidated(spark, sf):
    return re_.consolidated(_wide(spark, sf), ("IGW", "IGQ"), ("TRX", "TRZ"), ("IGW", "IGQ"))
