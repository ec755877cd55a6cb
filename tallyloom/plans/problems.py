"""Queries of the general data problems (1, 3, 4) over the lab tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import cell_label_key, gene_key, sample_tag_key, sql_cell_label_key, sql_gene_key
from ..functions.text import sql_strip
from ..operators import heavy_keys, shred, wide
from ..operators.latest import latest_by
from .tables import read

HEAVY_SHARE = 0.02


# ------------------------------------------------------- 1: a few keys hold most records


def newest_molecules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mol_id, cell_label, gene`` of the newest delivery of each molecule; the keys are canonical or null."""
    m = read(spark, sf_dir, "molecule")
    return latest_by(m, {"mol_id": F.col("mol_id")}, F.col("loaded_at"), {"cell_label": cell_label_key(F.col("cell_label")), "gene": gene_key(F.col("gene"))})


def p1_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Molecules of every cell label and every gene, the heavy keys marked."""
    counts = heavy_keys.count_by_each_key(newest_molecules(spark, sf_dir), {"cell_label": F.col("cell_label"), "gene": F.col("gene")})
    return heavy_keys.mark_heavy(counts, HEAVY_SHARE).select("key_kind", "key_value", F.col("n_records").alias("n_molecules"), "is_heavy")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys that at least 2 % of all molecules have."""
    return p1_counts(spark, sf_dir).filter("is_heavy").select("key_kind", "key_value")


SQL_NEWEST = f"""newest AS (
  SELECT mol_id, cell_label, gene FROM (
    SELECT mol_id, {sql_cell_label_key("cell_label")} AS cell_label, {sql_gene_key("gene")} AS gene,
      row_number() OVER (PARTITION BY mol_id ORDER BY loaded_at DESC NULLS LAST) AS k
    FROM molecule WHERE mol_id IS NOT NULL) WHERE k = 1)"""

SQL_P1 = f"""WITH {SQL_NEWEST}, counts AS (
  SELECT 'cell_label' AS key_kind, cell_label AS key_value, count(*) AS n FROM newest WHERE cell_label IS NOT NULL GROUP BY cell_label
  UNION ALL SELECT 'gene', gene, count(*) FROM newest WHERE gene IS NOT NULL GROUP BY gene),
marked AS (SELECT key_kind, key_value, n AS n_molecules, n * 50 >= (SELECT count(*) FROM newest) AS is_heavy FROM counts)"""


# ------------------------------------------------------- 3: nested records to flat tables


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits with a gene and a score, numbered within their record."""
    return p3_hits(spark, sf_dir).filter("gene IS NOT NULL AND bit_score IS NOT NULL").select("record_id", "hit_no", "gene")


def p3_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.hit_table(read(spark, sf_dir, "pyir_records"))


def p3_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.segment_table(read(spark, sf_dir, "pyir_records"))


def p3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.record_table(read(spark, sf_dir, "pyir_records"))


def p3_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.level_table(read(spark, sf_dir, "pyir_records"))


_SQL_NUMBER = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"


def _sql_text(path: str) -> str:
    """A field of ``j`` that is a text and not blank, trimmed."""
    return f"CASE WHEN json_type(j, '{path}') = 'VARCHAR' THEN nullif({sql_strip(f"json_extract_string(j, '{path}')")}, '') END"


def _sql_number(path: str) -> str:
    """A field of ``j`` that is a number, or a text that reads as one."""
    t = sql_strip(f"json_extract_string(j, '{path}')")
    numeric = f"json_type(j, '{path}') IN ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE')"
    return f"CASE WHEN {numeric} OR json_type(j, '{path}') = 'VARCHAR' AND regexp_full_match({t}, '{_SQL_NUMBER}') THEN try_cast({t} AS DOUBLE) END"


def _sql_int(path: str) -> str:
    x = _sql_number(path)
    return f"CASE WHEN {x} = floor({x}) AND abs({x}) < 2147483648 THEN CAST({x} AS INTEGER) END"


def _sql_child(of: str, name: str) -> str:
    return f"""json_extract({of}, '$."' || {name} || '"')"""


#: One payload a record; its objects outside arrays; the record among them; its Hits, decoded if they are held as text; a walk in document order that
#: stops at each hit.
SQL_RECORDS = f"""WITH RECURSIVE chosen AS (
  SELECT record_id, arg_max(payload, struct_pack(a := CASE WHEN {sql_strip("payload")} LIKE '%}}' THEN 1 ELSE 0 END, b := coalesce(loaded_at, TIMESTAMP '0001-01-01'), c := payload)) AS payload
  FROM pyir_records WHERE record_id IS NOT NULL AND payload IS NOT NULL GROUP BY record_id),
parsed AS (SELECT record_id, CAST(payload AS JSON) AS j FROM chosen WHERE json_valid(payload)),
objects AS (
  SELECT record_id, 0 AS depth, '' AS place, j FROM parsed WHERE json_type(j) = 'OBJECT'
  UNION ALL
  SELECT record_id, depth + 1, place || lpad(CAST(k.i AS VARCHAR), 6, '0'), {_sql_child("j", "k.name")}
  FROM objects, LATERAL (SELECT unnest(json_keys(j)) AS name, generate_subscripts(json_keys(j), 1) AS i) k WHERE json_type({_sql_child("j", "k.name")}) = 'OBJECT'),
records AS (
  SELECT record_id, arg_min(j, struct_pack(a := CASE WHEN list_contains(json_keys(j), 'Hits') THEN 0 ELSE 1 END, b := depth, c := place)) AS j
  FROM objects WHERE list_contains(json_keys(j), 'Hits') OR list_contains(json_keys(j), 'Sequence ID') GROUP BY record_id),
texts AS (
  SELECT record_id, json_extract(j, '$.Hits') AS hits, 0 AS turn FROM records
  UNION ALL SELECT record_id, CAST(json_extract_string(hits, '$') AS JSON), turn + 1 FROM texts WHERE json_type(hits) = 'VARCHAR' AND json_valid(json_extract_string(hits, '$'))),
walk AS (
  SELECT record_id, '' AS place, j, json_type(j) = 'OBJECT' AND list_contains(json_keys(j), 'gene') AS is_hit
  FROM (SELECT record_id, arg_max(hits, turn) AS j FROM texts GROUP BY record_id) WHERE json_type(j) IN ('OBJECT', 'ARRAY')
  UNION ALL
  SELECT record_id, place || lpad(CAST(c.i AS VARCHAR), 6, '0'), c.j, json_type(c.j) = 'OBJECT' AND list_contains(json_keys(c.j), 'gene')
  FROM walk, LATERAL (
    SELECT unnest(CASE WHEN json_type(walk.j) = 'ARRAY' THEN CAST(walk.j AS JSON[]) ELSE list_transform(json_keys(walk.j), lambda k: {_sql_child("walk.j", "k")}) END) AS j,
      unnest(range(CASE WHEN json_type(walk.j) = 'ARRAY' THEN CAST(json_array_length(walk.j) AS BIGINT) ELSE len(json_keys(walk.j)) END)) AS i) c
  WHERE NOT is_hit AND json_type(c.j) IN ('OBJECT', 'ARRAY')),
hits AS (SELECT record_id, CAST(row_number() OVER (PARTITION BY record_id ORDER BY place) AS INTEGER) AS hit_no, j FROM walk WHERE is_hit),
hit_table AS (
  SELECT record_id, hit_no, {_sql_text("$.gene")} AS gene, {_sql_number("$.bit_score")} AS bit_score, {_sql_number("$.e_value")} AS e_value, {_sql_text("$.gene_type")} AS gene_type,
    {_sql_number("$.percent_identity")} AS percent_identity, {_sql_text("$.percent_fraction")} AS percent_fraction, {_sql_int("$.alignment_start")} AS alignment_start, {_sql_int("$.alignment_end")} AS alignment_end
  FROM hits),
segment_table AS (
  SELECT record_id, hit_no, CAST(segment_no AS INTEGER) AS segment_no, {_sql_text("$.region")} AS region, {_sql_int("$.span.from")} AS span_from, {_sql_int("$.span.to")} AS span_to, {_sql_int("$.matches")} AS matches
  FROM (SELECT record_id, hit_no, unnest(CAST(json_extract(j, '$.segments') AS JSON[])) AS j, generate_subscripts(CAST(json_extract(j, '$.segments') AS JSON[]), 1) AS segment_no FROM hits WHERE json_type(j, '$.segments') = 'ARRAY')),
record_table AS (
  SELECT record_id, c.record_id = r.record_id IS TRUE AS is_complete, {_sql_text('$."Sequence ID"')} AS sequence_id, {_sql_int('$."Sequence Length"')} AS sequence_length, {_sql_text('$."Domain Classification"')} AS domain,
    {_sql_text('$."Chain type"')} AS chain_type, {_sql_text("$.Productive")} AS productive, {_sql_text("$.CDR3.NT")} AS cdr3_nt, {_sql_int('$.CDR3.Quality."Lowest Phred"')} AS lowest_phred,
    CAST(coalesce(n, 0) AS INTEGER) AS n_hits
  FROM chosen c LEFT JOIN records r USING (record_id) LEFT JOIN (SELECT record_id, count(*) AS n FROM hits GROUP BY record_id) USING (record_id))"""


# ------------------------------------------------------- 4: attribute-value rows to wide tables

_TAG_VALUES = {"reads": "int", "raw_mols": "int"}


def _given(name: str) -> F.Column:
    return F.when(F.col(name) >= 0, F.col(name))


def _tag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read(spark, sf_dir, "sample_tag_cell")
    return wide.narrow_rows(t, F.col("cell"), sample_tag_key(F.col("tag")), F.col("loaded_at"), {v: _given(v) for v in _TAG_VALUES})


def p4_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per cell with the reads and the raw molecules of every tag."""
    return wide.widen(_tag_rows(spark, sf_dir), _TAG_VALUES, entity="cell")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filled places of the wide table."""
    w = p4_wide(spark, sf_dir)
    names = [c.removesuffix("_reads") for c in w.columns if c.endswith("_reads")]
    return wide.filled(w, "cell", names, list(_TAG_VALUES)).withColumnRenamed("attribute", "tag")


_SQL_TAG = f"""lower({sql_strip(f"split_part({sql_strip('tag')}, '|', 1)")})"""

SQL_TAGS = f"""SELECT cell, tag, CASE WHEN reads >= 0 THEN reads END AS reads, CASE WHEN raw_mols >= 0 THEN raw_mols END AS raw_mols FROM (
  SELECT cell, reads, raw_mols, 'SampleTag' || lpad(regexp_extract(t, '^sampletag([0-9]{{1,2}})_', 1), 2, '0') || '_' || regexp_extract(t, '_([a-z]+)$', 1) AS tag,
    row_number() OVER (PARTITION BY cell, regexp_replace(t, '^sampletag0?([0-9])_', 'sampletag0\\1_') ORDER BY loaded_at DESC NULLS LAST) AS k
  FROM (SELECT *, {_SQL_TAG} AS t FROM sample_tag_cell WHERE cell IS NOT NULL)
  WHERE regexp_full_match(t, 'sampletag[0-9]{{1,2}}_[a-z]+'))
WHERE k = 1"""

SQL_P4_WIDE = f"""SELECT * FROM (PIVOT ({SQL_TAGS}) ON tag USING CAST(first(reads) AS INTEGER) AS reads, CAST(first(raw_mols) AS INTEGER) AS raw_mols GROUP BY cell)"""

QUERIES = {
    "p1_found": p1_found,
    "p1_counts": p1_counts,
    "p3_found": p3_found,
    "p3_hits": p3_hits,
    "p3_segments": p3_segments,
    "p3_records": p3_records,
    "p3_levels": p3_levels,
    "p4_found": p4_found,
    "p4_wide": p4_wide,
}

SQL = {
    "p1_found": f"{SQL_P1} SELECT key_kind, key_value FROM marked WHERE is_heavy",
    "p1_counts": f"{SQL_P1} SELECT * FROM marked",
    "p3_found": f"{SQL_RECORDS} SELECT record_id, hit_no, gene FROM hit_table WHERE gene IS NOT NULL AND bit_score IS NOT NULL",
    "p3_hits": f"{SQL_RECORDS} SELECT h.*, sequence_id FROM hit_table h JOIN record_table USING (record_id)",
    "p3_segments": f"{SQL_RECORDS} SELECT * FROM segment_table",
    "p3_records": f"{SQL_RECORDS} SELECT * FROM record_table",
    "p4_found": f"SELECT cell, tag FROM ({SQL_TAGS}) WHERE reads IS NOT NULL AND raw_mols IS NOT NULL",
    "p4_wide": SQL_P4_WIDE,
}
