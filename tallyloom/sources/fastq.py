"""FASTQ: records, pairs, names of files, and writing."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import digest_number

from ..operators.joins import join_by_id
from .files import open_bytes, stream

SCHEMA = "file string, record bigint, read_id string, seq string, qual string"


def _records(path: str) -> Iterator[tuple]:
    with open_bytes(path) as f:
        n = 0
        while True:
            head = f.readline()
            if not head:
                return
            seq, plus, qual = (f.readline().decode().rstrip("\r\n") for _ in range(3))
            title = head.decode().rstrip("\r\n")
            if not title and not seq:
                continue
            if not title.startswith("@") or not plus.startswith("+") or len(seq) != len(qual):
                raise ValueError(f"{path}: record {n + 1} is damaged")
            n += 1
            yield path, n, title[1:].split()[0].removesuffix("/1").removesuffix("/2"), seq, qual


def read_fastq(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file, record, read_id, seq, qual``; a damaged record is an error."""
    return stream(spark, paths, SCHEMA, _records)


def read_pairs(spark: SparkSession, first: list[str], second: list[str]) -> DataFrame:
    """``read_id, r1_seq, r1_qual, r2_seq, r2_qual``: mates joined by id; a read without its mate is an error."""
    side = lambda paths, p: read_fastq(spark, paths).select("read_id", F.col("seq").alias(f"{p}_seq"), F.col("qual").alias(f"{p}_qual"))
    return join_by_id(side(first, "r1"), side(second, "r2"), "read_id")


def as_lines(reads: DataFrame, read_id: str = "read_id", seq: str = "seq", qual: str = "qual") -> DataFrame:
    """One text of four lines per record, for a text sink."""
    return reads.select(F.concat(F.lit("@"), F.col(read_id), F.lit("\n"), F.col(seq), F.lit("\n+\n"), F.col(qual)).alias("value"))


def file_fields(name: Column) -> dict[str, Column]:
    """Library, sample number, lane, mate and chunk of a file name like ``lib_S1_L002_R1_001.fastq.gz``; null if it isn't one."""
    pattern = r"^(.+?)(?:_S(\d+))?(?:_L(\d{3}))?_R([12])(?:_(\d{3}))?\.(?:fastq|fq)(?:\.gz)?$"
    part = lambda i: F.nullif(F.regexp_extract(name, pattern, i), F.lit(""))
    return {"library": part(1), "sample_no": part(2), "lane": part(3), "mate": part(4), "chunk": part(5)}


def paired_files(files: DataFrame, name: str = "name") -> DataFrame:
    """``library, lane, chunk, r1, r2``: the two files of each part of a library; either is null where it lacks."""
    f = files.select(F.col(name).alias("name"), *[c.alias(k) for k, c in file_fields(F.col(name)).items()]).filter("mate IS NOT NULL")
    key = [F.coalesce(k, F.lit("-")).alias(k) for k in ("library", "lane", "chunk")]
    mate = lambda m: F.min(F.when(F.col("mate") == m, F.col("name")))
    return f.groupBy(*key).agg(mate("1").alias("r1"), mate("2").alias("r2"))


def subsample(reads: DataFrame, target: float, total: int | None = None, seed: int = 42, read_id: str = "read_id") -> DataFrame:
    """A share of the reads (``target`` up to 1) or, about, a number of them (then ``total`` is needed); both mates of a pair are taken or left.

    A number above the total is an error.
    """
    if target > 1:
        if total is None or target > total:
            raise ValueError("more reads are asked for than there are")
        target = target / total
    return reads.filter(digest_number(read_id, seed=seed) < int(target * 2**32))
