"""Domain tables of the queries, drawn from the test tables, each as a DataFrame and as a SQL common table.

The engine's operators take column names; here the domain's names are bound to the columns of
the tables at hand. Where no table holds a domain value (read sequences, say) it is derived from a key
by a digest, which both engines compute alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import cell_label_key, gene_key, sample_tag_key, sql_cell_label_key, sql_gene_key
from ..functions.text import sql_strip, strip
from ..operators.latest import latest_by
from .tables import read

HEX, LETTERS = "0123456789abcdef", "ACGTACGTACGTACGT"

# ---------------------------------------------------------------- molecules


def molecules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest delivery of each molecule that has both keys: mol_id, cell, gene, umi, raw_reads, rsec_reads, dbec_reads, corrected_umi."""
    m = read(spark, sf_dir, "molecule")
    values = {"cell": cell_label_key(F.col("cell_label")), "gene": gene_key(F.col("gene"))} | {c: F.col(c) for c in ("umi", "raw_reads", "rsec_reads", "dbec_reads", "corrected_umi")}
    return latest_by(m, {"mol_id": F.col("mol_id")}, F.col("loaded_at"), values).filter("cell IS NOT NULL AND gene IS NOT NULL")


SQL_MOL = f"""mol AS (
  SELECT mol_id, cell, gene, umi, raw_reads, rsec_reads, dbec_reads, corrected_umi FROM (
    SELECT *, row_number() OVER (PARTITION BY mol_id ORDER BY loaded_at DESC NULLS LAST, cell DESC NULLS LAST, gene DESC NULLS LAST, umi DESC NULLS LAST,
      raw_reads DESC NULLS LAST, rsec_reads DESC NULLS LAST, dbec_reads DESC NULLS LAST, corrected_umi DESC NULLS LAST) AS k
    FROM (SELECT mol_id, {sql_cell_label_key("cell_label")} AS cell, {sql_gene_key("gene")} AS gene, umi, raw_reads, rsec_reads, dbec_reads, corrected_umi, loaded_at
      FROM molecule WHERE mol_id IS NOT NULL))
  WHERE k = 1 AND cell IS NOT NULL AND gene IS NOT NULL)"""


def cell_gene(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.molecules import cell_gene_counts

    return cell_gene_counts(molecules(spark, sf_dir))


SQL_CELL_GENE = f"""{SQL_MOL}, cell_gene AS (
  SELECT cell, gene, coalesce(sum(raw_reads), 0)::BIGINT AS reads, coalesce(sum(CASE WHEN dbec_reads > 0 THEN dbec_reads END), 0)::BIGINT AS dbec_reads,
    count(CASE WHEN raw_reads > 0 THEN 1 END) AS raw_mols, count(CASE WHEN rsec_reads > 0 THEN 1 END) AS rsec_mols, count(CASE WHEN dbec_reads > 0 THEN 1 END) AS dbec_mols
  FROM mol GROUP BY cell, gene)"""

# ---------------------------------------------------------------- called cells


def called_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell (index), algorithm: each called cell once."""
    p = read(spark, sf_dir, "putative_cells")
    return p.filter("cell_index IS NOT NULL").groupBy(F.col("cell_index").alias("cell")).agg(F.min(F.initcap(strip("algorithm"))).alias("algorithm"))


SQL_CALLED = f"""called AS (
  SELECT cell_index AS cell, min(upper(substr({sql_strip("algorithm")}, 1, 1)) || lower(substr({sql_strip("algorithm")}, 2))) AS algorithm
  FROM putative_cells WHERE cell_index IS NOT NULL GROUP BY cell_index)"""

# ---------------------------------------------------------------- sample tags


def tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell, tag, reads, dbec_reads, raw_mols: newest rows of known tags, nulls and negatives as 0."""
    t = read(spark, sf_dir, "sample_tag_cell")
    known = {v: F.greatest(F.coalesce(F.col(v), F.lit(0)), F.lit(0)) for v in ("reads", "dbec_reads", "raw_mols")}
    return latest_by(t, {"cell": F.col("cell"), "tag": sample_tag_key(F.col("tag"))}, F.col("loaded_at"), known)


_TAG = f"lower({sql_strip(f'''split_part({sql_strip('tag')}, '|', 1)''')})"
SQL_TAGS = f"""tags AS (
  SELECT cell, tag, reads, dbec_reads, raw_mols FROM (
    SELECT *, row_number() OVER (PARTITION BY cell, tag ORDER BY loaded_at DESC NULLS LAST, reads DESC, dbec_reads DESC, raw_mols DESC) AS k
    FROM (SELECT cell, 'SampleTag' || lpad(regexp_extract(t, '^sampletag([0-9]{{1,2}})_', 1), 2, '0') || '_' || regexp_extract(t, '_([a-z]+)$', 1) AS tag, loaded_at,
        greatest(coalesce(reads, 0), 0) AS reads, greatest(coalesce(dbec_reads, 0), 0) AS dbec_reads, greatest(coalesce(raw_mols, 0), 0) AS raw_mols
      FROM (SELECT *, {_TAG} AS t FROM sample_tag_cell WHERE cell IS NOT NULL) WHERE regexp_full_match(t, 'sampletag[0-9]{{1,2}}_[a-z]+')))
  WHERE k = 1)"""

# ---------------------------------------------------------------- reads


def letters(*salted: Column) -> Column:
    return F.concat(*[F.translate(F.md5(s), HEX, LETTERS) for s in salted])


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic read pairs, one per molecule id, and what an aligner would say of them.

    read_id, r1_seq, r1_qual, r2_seq, r2_qual, target, position, cigar, status, library, is_control.
    """
    m = read(spark, sf_dir, "molecule").filter("mol_id IS NOT NULL").groupBy("mol_id").agg(F.max(F.struct("loaded_at", "target")).alias("x"))
    k = F.col("mol_id")
    text = k.cast("string")
    salted = lambda s: F.concat(F.lit(s), text)
    tail = F.when(k % 4 == 0, F.lit("TTTTTTATTTGC")).otherwise(letters(salted("t")))
    suffix = F.when(k % 7 == 0, "|stAbO").when(k % 7 == 1, "|pAbO").when(k % 7 == 2, "|TVDJ").otherwise("")
    return m.select(
        k.alias("read_id"),
        F.concat(F.substring(letters(salted("a"), salted("b")), 1, 56), tail).substr(F.lit(1), (56 + k % 16).cast("int")).alias("r1_seq"),
        F.concat(F.md5(salted("c")), F.md5(salted("d")), F.md5(salted("e"))).substr(F.lit(1), (56 + k % 16).cast("int")).alias("r1_qual"),
        letters(salted("f"), salted("g")).substr(F.lit(1), (38 + k % 27).cast("int")).alias("r2_seq"),
        F.concat(F.md5(salted("h")), F.md5(salted("i"))).substr(F.lit(1), (38 + k % 27).cast("int")).alias("r2_qual"),
        F.concat(F.coalesce(F.substring_index("x.target", "|", 1), F.lit("*")), suffix).alias("target"),
        (k % 31).cast("int").alias("position"),
        F.concat((k % 9 + 1).cast("string"), F.lit("S"), (k % 60 + 10).cast("string"), F.lit("M2I"), (k % 5).cast("string"), F.lit("M")).alias("cigar"),
        F.when(k % 11 < 6, "1").when(k % 11 == 6, "MAcorrected").when(k % 11 == 7, "alignment_not_unique").when(k % 11 == 8, "ambiguous[A+B]").when(k % 11 == 9, "x").otherwise("no_feature").alias("status"),
        F.concat(F.lit("lib"), (k % 5 + 1).cast("string")).alias("library"),
        (k % 97 == 0).alias("is_control"),
    )


def _sql_letters(*salts: str) -> str:
    return " || ".join(f"translate(md5('{s}' || t), '{HEX}', '{LETTERS}')" for s in salts)


SQL_READS = f"""reads AS (
  SELECT mol_id AS read_id,
    substr(substr({_sql_letters("a", "b")}, 1, 56) || CASE WHEN mol_id % 4 = 0 THEN 'TTTTTTATTTGC' ELSE {_sql_letters("t")} END, 1, 56 + mol_id % 16) AS r1_seq,
    substr(md5('c' || t) || md5('d' || t) || md5('e' || t), 1, 56 + mol_id % 16) AS r1_qual,
    substr({_sql_letters("f", "g")}, 1, 38 + mol_id % 27) AS r2_seq,
    substr(md5('h' || t) || md5('i' || t), 1, 38 + mol_id % 27) AS r2_qual,
    coalesce(split_part(target, '|', 1), '*') || CASE mol_id % 7 WHEN 0 THEN '|stAbO' WHEN 1 THEN '|pAbO' WHEN 2 THEN '|TVDJ' ELSE '' END AS target,
    (mol_id % 31)::INTEGER AS position,
    (mol_id % 9 + 1) || 'S' || (mol_id % 60 + 10) || 'M2I' || (mol_id % 5) || 'M' AS cigar,
    CASE WHEN mol_id % 11 < 6 THEN '1' WHEN mol_id % 11 = 6 THEN 'MAcorrected' WHEN mol_id % 11 = 7 THEN 'alignment_not_unique' WHEN mol_id % 11 = 8 THEN 'ambiguous[A+B]' WHEN mol_id % 11 = 9 THEN 'x' ELSE 'no_feature' END AS status,
    'lib' || (mol_id % 5 + 1) AS library, mol_id % 97 = 0 AS is_control
  FROM (SELECT mol_id, mol_id::VARCHAR AS t, target, row_number() OVER (PARTITION BY mol_id ORDER BY loaded_at DESC NULLS LAST, target DESC NULLS LAST) AS k FROM molecule WHERE mol_id IS NOT NULL)
  WHERE k = 1)"""
