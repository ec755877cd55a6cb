"""Tables in text: headerless CSV, sectioned reports, matrices in triplets, counts per sample."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MISSING = ["x", "*", "", "NA"]


def read_positional(spark: SparkSession, paths: str | list[str], schema: str, delimiter: str = ",", missing: list[str] | None = None) -> DataFrame:
    """Headerless, perhaps gzipped, files whose columns are named by position; the given marks are null in text columns."""
    df = spark.read.schema(schema).option("sep", delimiter).option("comment", "#").csv(paths)
    if missing is None:
        return df
    return df.select(*[F.when(~F.col(c).isin(missing), F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def parse_sections(lines: DataFrame, value: str = "value", line_no: str = "line_no", file: str = "file") -> DataFrame:
    """``file, section, row_no, cells`` of sectioned CSV: ``#Name#`` begins a section, ``##`` lines are the run's header, blank lines nothing.

    The section of a line is the last one begun before it in its file. Reports are small; a file is one window group.
    """
    v = F.trim(F.col(value))
    begins = F.when(v.rlike("^#[^#]+#"), F.regexp_extract(v, "^#([^#]+)#", 1))
    w = Window.partitionBy(file).orderBy(line_no).rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.select(file, line_no, v.alias("v"), begins.alias("b")).withColumn("section", F.last("b", ignorenulls=True).over(w))
    rows = marked.filter(F.col("b").isNull() & (F.col("v") != "") & ~F.startswith("v", F.lit("##")) & F.col("section").isNotNull())
    return rows.select(file, "section", F.row_number().over(Window.partitionBy(file, "section").orderBy(line_no)).alias("row_no"), F.split("v", ",").alias("cells"))


def section_metrics(sections: DataFrame, file: str = "file") -> DataFrame:
    """``file, section, row_no, metric, value``: every cell below a section's first row, under its name."""
    w = Window.partitionBy(file, "section").orderBy("row_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    named = sections.withColumn("names", F.first("cells").over(w)).filter("row_no > 1")
    cell = F.posexplode(F.arrays_zip("names", "cells"))
    return named.select(file, "section", (F.col("row_no") - 1).alias("row_no"), cell.alias("i", "x")).select(file, "section", "row_no", F.trim("x.names").alias("metric"), F.trim("x.cells").alias("value"))


def run_header(lines: list[str]) -> dict[str, str]:
    """Names and values of a report's ``##`` lines (``## Name: value``)."""
    out = {}
    for line in lines:
        if line.startswith("##") and ":" in line:
            k, _, v = line.lstrip("#").partition(":")
            out[k.strip()] = v.strip()
    return out


def section_lines(name: str, header: list[str], rows: list[list]) -> list[str]:
    """The lines of one section, for a report of a few rows."""
    return [f"#{name}#", ",".join(header), *[",".join("NA" if c is None else str(c) for c in r) for r in rows], ""]


def parse_matrix_market(lines: DataFrame, value: str = "value") -> DataFrame:
    """``i, j, v`` of coordinate lines. The size line, the only one whose entry can't be told from others by form, must be removed by its place: it is the first after the comments."""
    p = F.split(F.trim(F.col(value)), r"\s+")
    return lines.filter(~F.startswith(F.col(value), F.lit("%")) & (F.size(p) == 3)).select(F.get(p, F.lit(0)).cast("int").alias("i"), F.get(p, F.lit(1)).cast("int").alias("j"), F.get(p, F.lit(2)).cast("double").alias("v"))


def read_matrix_market(spark: SparkSession, path: str, row_names: str, col_names: str) -> DataFrame:
    """``row, col, v``: triplets joined to the names of rows and columns, which are numbered by line.

    The size line is recognised as the triplet with the file's own numbers of rows and columns and entries.
    """
    t = parse_matrix_market(spark.read.text(path))
    names = lambda p, c: _numbered(spark, p).select(F.col("line_no").alias(c), F.col("value").alias({"i": "row", "j": "col"}[c]))
    r, c = names(row_names, "i"), names(col_names, "j")
    size = (r.count(), c.count(), t.count() - 1)
    body = t.filter(~((F.col("i") == size[0]) & (F.col("j") == size[1]) & (F.col("v") == size[2])))
    return body.join(r, "i").join(c, "j").select("row", "col", "v")


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a small file with their numbers from 1, in the order of the file."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split(F.regexp_replace("value", "\\r?\\n$", ""), "\\r?\\n")).alias("p", "value")).select((F.col("p") + 1).alias("line_no"), "value")


def as_matrix_market(triplets: DataFrame, row: str, col: str, value: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines of triplets (with the size line's numbers in the names' order), and numbered names of rows and columns."""
    from ..operators.running import numbered

    number = lambda c: numbered(triplets.select(c).distinct(), [], [F.asc(c)], "no").withColumn("no", F.col("no").cast("int"))
    r, k = number(row), number(col)
    body = triplets.join(r.withColumnRenamed("no", "i"), row).join(k.withColumnRenamed("no", "j"), col)
    return body.select(F.concat_ws(" ", "i", "j", F.col(value)).alias("value")), r, k


def feature_counts(table: DataFrame, gene: str = "Geneid", least: float = 1) -> DataFrame:
    """``gene, sample, n`` from a counts table: place columns dropped, samples unpivoted, genes with a row sum above ``least`` kept."""
    drop = {"Chr", "Start", "End", "Strand", "Length", gene}
    samples = [c for c in table.columns if c not in drop]
    total = sum((F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in samples[1:]), F.coalesce(F.col(f"`{samples[0]}`"), F.lit(0)))
    kept = table.filter(total > least).select(F.col(gene).alias("gene"), *[F.col(f"`{c}`").cast("double") for c in samples])
    return kept.unpivot(["gene"], [f"`{c}`" for c in samples], "sample", "n")


def stacked_samples(values: DataFrame, gene: str, sample: str, value: str, samples: list[str]) -> DataFrame:
    """Wide by sample; repeated genes are summed, missing ones 0."""
    return values.groupBy(gene).pivot(sample, samples).agg(F.sum(value)).fillna(0)


def sample_list(rows: list[dict], base: str) -> list[dict]:
    """Folders of a sample list made absolute, flags made truth values (missing is false)."""
    return [{"data_folder": r["data_folder"] if os.path.isabs(r["data_folder"]) else os.path.normpath(os.path.join(base, r["data_folder"])), "use_as_ref": str(r.get("use_as_ref", "")).strip().lower() in ("true", "t", "1", "yes")} for r in rows]


def of_cells(table: DataFrame, cells: DataFrame, cell: str) -> DataFrame:
    """Rows of the given cells."""
    from ..operators.joins import sized_broadcast

    return table.join(sized_broadcast(cells.select(cell).distinct()), cell, "left_semi")
