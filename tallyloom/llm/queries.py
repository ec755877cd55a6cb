"""Queries of the training-data problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import sql_strip, strip, strip_or_null
from ..plans.problems import SQL_NEWEST, newest_molecules
from ..plans.tables import read
from ..session import materialize
from . import mixing, sentences, termfreq, tokenize, topn

# ------------------------------------------------------- 2: top items of every group

TOP = 3


def _hit_order() -> list[F.Column]:
    return [F.desc("bit_score"), F.asc_nulls_last("e_value"), F.asc("gene")]


def p2_top(spark: SparkSession, sf_dir: str, n: int = TOP) -> DataFrame:
    """The ``n`` genes of highest score of every sequence, with their scores."""
    h = read(spark, sf_dir, "pyir_hits")
    trimmed = strip("gene")
    gene = F.when(F.startswith(trimmed, F.lit("lcl|")), strip(F.substring(trimmed, 5, 1 << 20))).otherwise(trimmed)
    rows = h.select(strip_or_null("sequence_id").alias("sequence_id"), F.nullif(gene, F.lit("")).alias("gene"), "bit_score", "e_value")
    rows = rows.filter(F.col("bit_score").isNotNull() & ~F.isnan("bit_score"))
    return topn.top_n(rows, "sequence_id", "gene", _hit_order(), n).withColumnRenamed("rank_no", "hit_rank")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three genes of every sequence."""
    return p2_top(spark, sf_dir).select("sequence_id", "hit_rank", "gene")


SQL_P2 = f"""WITH rows AS (
  SELECT nullif({sql_strip("sequence_id")}, '') AS sequence_id, nullif({sql_strip(f"regexp_replace({sql_strip('gene')}, '^lcl[|]', '')")}, '') AS gene, bit_score, e_value
  FROM pyir_hits WHERE bit_score IS NOT NULL AND NOT isnan(bit_score)),
once AS (
  SELECT *, row_number() OVER (PARTITION BY sequence_id, gene ORDER BY bit_score DESC, e_value ASC NULLS LAST) AS k
  FROM rows WHERE sequence_id IS NOT NULL AND gene IS NOT NULL),
ranked AS (
  SELECT sequence_id, gene, bit_score, e_value, CAST(row_number() OVER (PARTITION BY sequence_id ORDER BY bit_score DESC, e_value ASC NULLS LAST, gene) AS INTEGER) AS hit_rank
  FROM once WHERE k = 1)"""

# ------------------------------------------------------- 5: frequency of every term

_RARE = {"gene": 3, "cell_label": 3}
_COMMON = {"gene": ("1/2", "cell_label"), "cell_label": ("1/4", "gene")}


def p5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every gene its molecules and cell labels, for every cell label its molecules and genes, with a verdict."""
    molecules = materialize(newest_molecules(spark, sf_dir).select("cell_label", "gene").dropna(), "molecules")
    both = F.array(
        F.struct(F.lit("gene").alias("key_kind"), F.col("gene").alias("key_value"), F.col("cell_label").alias("record")),
        F.struct(F.lit("cell_label").alias("key_kind"), F.col("cell_label").alias("key_value"), F.col("gene").alias("record")),
    )
    tokens = molecules.select(F.explode(both).alias("t")).select("t.*")
    counts = materialize(termfreq.term_counts(tokens, "key_kind", "key_value", "record"), "term-counts")
    return termfreq.mark(counts, "key_kind", _RARE, _COMMON).withColumnRenamed("occurrences", "n_molecules")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys too rare or too common to be useful."""
    return p5_counts(spark, sf_dir).filter("verdict IS NOT NULL").select("key_kind", "key_value", "verdict")


SQL_P5 = f"""WITH {SQL_NEWEST}, m AS (SELECT * FROM newest WHERE cell_label IS NOT NULL AND gene IS NOT NULL),
counts AS (
  SELECT 'gene' AS key_kind, gene AS key_value, count(*) AS n_molecules, count(DISTINCT cell_label) AS n_records,
    CASE WHEN count(DISTINCT cell_label) < 3 THEN 'rare' WHEN count(DISTINCT cell_label) * 2 > (SELECT count(DISTINCT cell_label) FROM m) THEN 'common' END AS verdict
  FROM m GROUP BY gene
  UNION ALL
  SELECT 'cell_label', cell_label, count(*), count(DISTINCT gene),
    CASE WHEN count(DISTINCT gene) < 3 THEN 'rare' WHEN count(DISTINCT gene) * 4 > (SELECT count(DISTINCT gene) FROM m) THEN 'common' END
  FROM m GROUP BY cell_label)"""

# ------------------------------------------------------- 6: encoding the corpus


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    return tokenize.encode(read(spark, sf_dir, "documents"), ["doc_id"], "text", tokenize.default_vocabulary(spark))


# ------------------------------------------------------- 7: mixing sources


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[dict]]:
    d = read(spark, sf_dir, "documents").withColumn("source", F.lower(strip("source")))
    sized = tokenize.count_tokens(d, ["doc_id", "source"], "text", tokenize.default_vocabulary(spark))
    return mixing.mix(sized, read(spark, sf_dir, "mix_targets"))


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix: every appearance of a document, in order of its virtual finish time."""
    return _mix(spark, sf_dir)[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares that the sources really reach."""
    return mixing.report(*_mix(spark, sf_dir))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources that can't reach their weight."""
    return p7_shares(spark, sf_dir).filter("is_short").select("source")


# ------------------------------------------------------- 8: sentences


def p8_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of every document, numbered, with its place."""
    return sentences.sentences(read(spark, sf_dir, "documents"), ["doc_id"], "text")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of all sentences."""
    return p8_sentences(spark, sf_dir).select("doc_id", "start_at", "end_at")


QUERIES = {
    "p2_found": p2_found,
    "p2_top": p2_top,
    "p5_found": p5_found,
    "p5_counts": p5_counts,
    "p6_ids": p6_ids,
    "p7_found": p7_found,
    "p7_mix": p7_mix,
    "p7_shares": p7_shares,
    "p8_found": p8_found,
    "p8_sentences": p8_sentences,
}

SQL = {
    "p2_found": f"{SQL_P2} SELECT sequence_id, hit_rank, gene FROM ranked WHERE hit_rank <= {TOP}",
    "p2_top": f"{SQL_P2} SELECT sequence_id, gene, bit_score, e_value, hit_rank FROM ranked WHERE hit_rank <= {TOP}",
    "p5_found": f"{SQL_P5} SELECT key_kind, key_value, verdict FROM counts WHERE verdict IS NOT NULL",
    "p5_counts": f"{SQL_P5} SELECT * FROM counts",
}
