"""SAM lines and BAM files."""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import open_bytes

BAM_SCHEMA = "file string, read_id string, flag int, reference string, position int, cigar string, seq string, tags map<string,string>"


def parse_sam(lines: DataFrame, value: str = "value") -> DataFrame:
    """``read_id, flag, reference, position, mapq, cigar, seq, qual, tags``: header lines are left out, tags are a map of text."""
    v = F.col(value)
    part = F.split(v, "\t")
    rows = lines.filter(~F.startswith(v, F.lit("@")) & (F.size(part) >= 11))
    tag = lambda t: F.struct(F.substring(t, 1, 2).alias("k"), F.substring(t, 6, 1 << 20).alias("v"))
    tags = F.map_from_entries(F.transform(F.slice(part, F.lit(12), F.greatest(F.size(part) - 11, F.lit(0))), tag))
    at = lambda i: F.get(part, F.lit(i))
    star = lambda c: F.nullif(c, F.lit("*"))
    return rows.select(
        at(0).alias("read_id"), at(1).cast("int").alias("flag"), star(at(2)).alias("reference"), at(3).cast("int").alias("position"), at(4).cast("int").alias("mapq"), star(at(5)).alias("cigar"), star(at(9)).alias("seq"), star(at(10)).alias("qual"), tags.alias("tags")
    )


def read_sam(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_sam(spark.read.text(paths))


def as_sam_lines(rows: DataFrame, tags: str = "tags") -> DataFrame:
    """SAM lines of the columns that ``parse_sam`` gives; tags are written as text, in order of their names."""
    text = lambda c, d: F.coalesce(F.col(c).cast("string"), F.lit(d))
    listed = F.transform(F.array_sort(F.map_entries(tags)), lambda e: F.concat(e["key"], F.lit(":Z:"), e["value"]))
    fixed = [text("read_id", "*"), text("flag", "4"), text("reference", "*"), text("position", "0"), text("mapq", "255"), text("cigar", "*"), F.lit("*"), F.lit("0"), F.lit("0"), text("seq", "*"), text("qual", "*")]
    return rows.select(F.concat_ws("\t", *fixed, listed).alias("value"))


def with_tag(rows: DataFrame, name: str, value: Column, tags: str = "tags") -> DataFrame:
    """``rows`` with one tag set, where its value isn't null."""
    rest = F.map_filter(tags, lambda k, _: k != name)
    return rows.withColumn(tags, F.when(value.isNull(), F.col(tags)).otherwise(F.map_concat(rest, F.create_map(F.lit(name), value.cast("string")))))


# The letters of packed bases and operations.
_BASES, _OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
_SIZES = {"A": "c", "c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


def _tags(data: bytes, at: int) -> list[tuple[str, str]]:
    out = []
    while at < len(data):
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            end = data.index(0, at)
            value, at = data[at:end].decode(), end + 1
        elif kind == "B":
            form = _SIZES[chr(data[at])]
            (n,) = struct.unpack_from("<i", data, at + 1)
            value = ",".join(map(str, struct.unpack_from(f"<{n}{form}", data, at + 5)))
            at += 5 + n * struct.calcsize(form)
        else:
            (x,) = struct.unpack_from("<" + _SIZES[kind], data, at)
            value, at = x.decode() if kind == "A" else str(x), at + struct.calcsize(_SIZES[kind])
        out.append((name, value))
    return out


def _alignments(path: str) -> Iterator[tuple]:
    import gzip

    with open_bytes(path) as raw, gzip.open(raw, "rb") as f:
        if f.read(4) != b"BAM\x01":
            raise ValueError(f"{path} is no BAM file")
        number = lambda: struct.unpack("<i", f.read(4))[0]
        f.read(number())
        names = []
        for _ in range(number()):
            names.append(f.read(number())[:-1].decode())
            number()
        while size := f.read(4):
            d = f.read(struct.unpack("<i", size)[0])
            ref, pos, l_name, _, _, n_ops, flag, l_seq = struct.unpack_from("<iiBBHHHi", d)
            at = 32 + l_name
            ops = struct.unpack_from(f"<{n_ops}I", d, at)
            at += 4 * n_ops
            packed = d[at : at + (l_seq + 1) // 2]
            seq = "".join(_BASES[x >> 4] + _BASES[x & 15] for x in packed)[:l_seq]
            at += (l_seq + 1) // 2 + l_seq
            yield path, d[32 : 31 + l_name].decode(), flag, names[ref] if ref >= 0 else None, pos + 1 if pos >= 0 else None, "".join(f"{o >> 4}{_OPS[o & 15]}" for o in ops) or None, seq or None, _tags(d, at)


def read_bam(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file, read_id, flag, reference, position (from 1), cigar, seq, tags``; one task streams each file."""
    schema = BAM_SCHEMA.replace("map<string,string>", "array<struct<k:string,v:string>>")
    names = [c.split()[0] for c in BAM_SCHEMA.split(", ")]

    def rows(path: str) -> Iterator[tuple]:
        for r in _alignments(path):
            yield (*r[:-1], [{"k": k, "v": v} for k, v in r[-1]])

    raw = stream_typed(spark, paths, schema, rows)
    return raw.select(*names[:-1], F.map_from_entries("tags").alias("tags"))


def stream_typed(spark: SparkSession, paths: list[str], schema: str, records) -> DataFrame:
    """Like ``files.stream`` for schemas with nested columns, whose types Arrow can't tell from empty batches."""
    import pyarrow as pa

    from ..session import ship
    from .files import BATCH

    ship(spark)

    kinds = [("file", pa.string()), ("read_id", pa.string()), ("flag", pa.int32()), ("reference", pa.string()), ("position", pa.int32()), ("cigar", pa.string()), ("seq", pa.string()), ("tags", pa.list_(pa.struct([("k", pa.string()), ("v", pa.string())])))]

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                rows: list[tuple] = []
                for r in records(path):
                    rows.append(r)
                    if len(rows) == BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], names=[n for n, _ in kinds])
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], names=[n for n, _ in kinds])

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)), "path")
    return listed.mapInArrow(run, schema)
