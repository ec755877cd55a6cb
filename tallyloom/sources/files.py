"""Streaming of whole files inside tasks."""

from __future__ import annotations

import gzip
import io
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import ship

BATCH = 5_000


def open_bytes(path: str) -> io.BufferedIOBase:
    """A file of any supported storage, decompressed if its name ends with ``.gz``."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        where, name = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
        raw = where.open_input_stream(name, compression=None)
    else:
        raw = open(path, "rb")  # noqa: SIM115
    return gzip.open(raw, "rb") if path.endswith(".gz") else raw


def stream(spark: SparkSession, paths: list[str], schema: str, records: Callable[[str], Iterator[tuple]]) -> DataFrame:
    """A table of what ``records`` yields for each path; one task per file."""
    ship(spark)
    names = [c.strip().split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                rows: list[tuple] = []
                for r in records(path):
                    rows.append(r)
                    if len(rows) == BATCH:
                        yield _batch(rows, names)
                        rows = []
                if rows:
                    yield _batch(rows, names)

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)), "path")
    return listed.mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
