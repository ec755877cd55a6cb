"""GFF and GTF: features with attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_features(lines: DataFrame, value: str = "value", style: str = "gtf") -> DataFrame:
    """``seqname, source, feature, start, end, score, strand, frame, attributes``; comments and blank lines are left out.

    ``style``: ``gtf`` (``key "value";``) or ``gff3`` (``key=value;``). Of a repeated key the last value counts. ``.`` is null.
    """
    v = F.col(value)
    p = F.split(v, "\t")
    rows = lines.filter(~F.startswith(v, F.lit("#")) & (F.size(p) == 9))
    at = lambda i: F.nullif(F.get(p, F.lit(i)), F.lit("."))
    pattern = r'([^\s;=]+)\s+"?([^";]*)"?\s*(?:;|$)' if style == "gtf" else r"([^;=\s]+)=([^;]*)"
    text = F.get(p, F.lit(8))
    keys, values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    numbered = F.transform(keys, lambda k, i: F.struct(k.alias("k"), F.get(values, i).alias("v"), (F.array_position(F.slice(keys, i + 2, F.lit(1 << 20)), k) > 0).alias("again")))
    attributes = F.map_from_entries(F.transform(F.filter(numbered, lambda x: ~x["again"]), lambda x: F.struct(x["k"].alias("k"), x["v"].alias("v"))))
    return rows.select(at(0).alias("seqname"), at(1).alias("source"), at(2).alias("feature"), at(3).cast("int").alias("start"), at(4).cast("int").alias("end"), at(5).cast("double").alias("score"), at(6).alias("strand"), at(7).cast("int").alias("frame"), attributes.alias("attributes"))


def read_features(spark: SparkSession, paths: str | list[str], style: str = "gtf") -> DataFrame:
    return parse_features(spark.read.text(paths), style=style)


def metadata(lines: DataFrame, value: str = "value") -> DataFrame:
    """``key, text`` of ``##`` lines."""
    v = F.col(value)
    rest = F.trim(F.substring(v, 3, 1 << 20))
    return lines.filter(F.startswith(v, F.lit("##")) & ~F.startswith(v, F.lit("###"))).select(F.substring_index(rest, " ", 1).alias("key"), F.trim(F.substr(rest, F.length(F.substring_index(rest, " ", 1)) + 1, F.lit(1 << 20))).alias("text"))


def filter_features(f: DataFrame, seqnames: list[str] | None = None, features: list[str] | None = None, sources: list[str] | None = None, attributes: dict[str, str] | None = None) -> DataFrame:
    """Features of the given names, types, sources and attribute values; what isn't given isn't asked for."""
    for c, names in (("seqname", seqnames), ("feature", features), ("source", sources)):
        if names is not None:
            f = f.filter(F.col(c).isin(names))
    for k, v in (attributes or {}).items():
        f = f.filter(F.try_element_at("attributes", F.lit(k)) == v)
    return f


def feature_stats(f: DataFrame) -> DataFrame:
    """Per type: how many, and how many have a length that is a multiple of 3 counted closed or half-open."""
    size = F.col("end") - F.col("start")
    return f.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.count_if((size + 1) % 3 == 0).alias("closed"), F.count_if(size % 3 == 0).alias("half_open"))


def to_gtf(gff: DataFrame, prefix: str = "", types: dict[str, str] | None = None) -> DataFrame:
    """Exons and their like with the gene and transcript that their parents name.

    ``Parent`` leads to the transcript, whose ``Parent`` is the gene. A feature whose parent is a gene itself has it as both.
    Two joins on ids; the order of lines doesn't matter.
    """
    a = lambda k: F.try_element_at("attributes", F.lit(k))
    strip = lambda c: F.regexp_replace(c, "^" + prefix, "") if prefix else c
    ids = gff.filter(a("ID").isNotNull()).select(a("ID").alias("id"), a("Parent").alias("up")).dropDuplicates(["id"])
    leaves = gff.filter(a("Parent").isNotNull()).withColumn("p", F.explode(F.split(a("Parent"), ",")))
    known = leaves.join(ids.select(F.col("id").alias("p"), F.col("up").alias("g")), "p", "left").withColumn("gene_id", strip(F.coalesce("g", "p"))).withColumn("transcript_id", strip(F.col("p")))
    kind = F.col("feature")
    for old, new in (types or {}).items():
        kind = F.when(F.col("feature") == old, new).otherwise(kind)
    return known.select("seqname", "source", kind.alias("feature"), "start", "end", "strand", "gene_id", "transcript_id")


def gene_of(attributes: Column) -> Column:
    """Its name, else its id."""
    get = lambda k: F.try_element_at(attributes, F.lit(k))
    return F.coalesce(get("gene_name"), get("gene_id"))


def countable_features(gtf: DataFrame, feature: str = "exon") -> DataFrame:
    """``chrom, f_start, f_end, f_strand, feature, kind`` for overlap counting; a feature without a strand is an error."""
    strand = F.when(F.col("strand").isin("+", "-"), F.col("strand")).otherwise(F.raise_error(F.lit("a feature has no strand")))
    return gtf.filter(F.col("feature") == feature).select(F.col("seqname").alias("chrom"), F.col("start").alias("f_start"), F.col("end").alias("f_end"), strand.alias("f_strand"), gene_of(F.col("attributes")).alias("feature"), F.lit(feature).alias("kind"))


def transcript_lengths(gtf: DataFrame) -> DataFrame:
    """Sum of the lengths of a transcript's distinct exons."""
    e = gtf.filter("feature = 'exon'").select(F.try_element_at("attributes", F.lit("transcript_id")).alias("transcript_id"), "start", "end").filter("transcript_id IS NOT NULL").distinct()
    return e.groupBy("transcript_id").agg(F.sum(F.col("end") - F.col("start") + 1).alias("length"))


def spike_in_features(sequences: DataFrame, name: str = "name", length: str = "length") -> DataFrame:
    """A gene and an exon over the whole of each spiked-in sequence."""
    both = sequences.withColumn("feature", F.explode(F.array(F.lit("exon"), F.lit("gene"))))
    return both.select(F.col(name).alias("seqname"), "feature", F.lit(1).alias("start"), F.col(length).alias("end"), F.lit("+").alias("strand"), F.create_map(F.lit("gene_id"), F.col(name), F.lit("transcript_id"), F.col(name)).alias("attributes"))


def as_lines(f: DataFrame) -> DataFrame:
    """GTF lines."""
    t = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    attrs = F.array_join(F.transform(F.array_sort(F.map_entries("attributes")), lambda e: F.concat(e["key"], F.lit(' "'), e["value"], F.lit('";'))), " ")
    cols = [t(c) if c in f.columns else F.lit(".") for c in ("seqname", "source", "feature", "start", "end", "score", "strand", "frame")]
    return f.select(F.concat_ws("\t", *cols, attrs).alias("value"))
