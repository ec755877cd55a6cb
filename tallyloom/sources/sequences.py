"""FASTA: sequences, and checks of a reference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_fasta(entries: DataFrame, value: str = "value") -> DataFrame:
    """``name, description, seq`` from texts that are one entry each, without its ``>``; blank ones are left out."""
    v = F.regexp_replace(F.col(value), "^>", "")
    head = F.regexp_replace(F.substring_index(v, "\n", 1), "\r$", "")
    seq = F.regexp_replace(F.substr(v, F.length(F.substring_index(v, "\n", 1)) + 1, F.lit(1 << 30)), r"\s", "")
    return entries.filter(F.trim(v) != "").select(F.substring_index(head, " ", 1).alias("name"), head.alias("description"), seq.alias("seq"))


def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Entries are split at ``>`` at the beginning of a line, by the text source itself."""
    return parse_fasta(spark.read.option("lineSep", "\n>").text(paths))


def as_lines(sequences: DataFrame) -> DataFrame:
    return sequences.select(F.concat(F.lit(">"), F.col("description"), F.lit("\n"), F.col("seq")).alias("value"))


def reference_problems(sequences: DataFrame) -> DataFrame:
    """``problem, name, n``: ids that repeat, and sequences that repeat (under their first name)."""
    ids = sequences.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit("repeated id").alias("problem"), "name", "n")
    same = sequences.groupBy(F.sha2("seq", 256).alias("k")).agg(F.min("name").alias("name"), F.count_distinct("name").alias("n")).filter("n > 1").select(F.lit("repeated sequence").alias("problem"), "name", "n")
    return ids.unionByName(same)


def completed_reference(sequences: DataFrame, suffix: str, poly_a: int = 0) -> DataFrame:
    """Names that end with the kind's suffix, and sequences with a poly-A tail."""
    name = F.when(F.endswith("name", F.lit(suffix)), F.col("name")).otherwise(F.concat("name", F.lit("|" + suffix)))
    return sequences.select(name.alias("name"), F.concat("seq", F.repeat(F.lit("A"), F.lit(poly_a))).alias("seq"))


def has_targets(sequences: DataFrame, suffixes: tuple[str, ...]) -> bool:
    """Whether any entry has a name that ends with one of the suffixes; stops at the first."""
    ends = F.lit(False)
    for s in suffixes:
        ends = ends | F.endswith("name", F.lit(s))
    return not sequences.filter(ends).limit(1).isEmpty()
