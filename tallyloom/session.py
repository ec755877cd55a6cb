"""Session helpers: how an operator cuts lineage so that its job survives a lost executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from contextlib import suppress
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_SHIPPED: set[str] = set()
_RELEASED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Where the session names none, a temporary folder serves local mode only; on a cluster that
    is an error, because a machine-local folder isn't seen by the other machines.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = sc.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="tallyloom-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
    return _OWN[app]


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, under this application's own folder."""
    return f"{shared_dir(spark)}/tallyloom-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and return a reader of it.

    Unlike a persisted or locally checkpointed frame, the table survives lost executors, and
    unlike an RDD checkpoint it is columnar, compressed and pruned when read. With
    ``partition_by`` the table is laid out by those columns, so a filter on them reads only its part.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    _release_at_exit(spark)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    reader = spark.read if partition_by else spark.read.schema(df.schema)
    if partition_by:
        kinds = {f.name: f for f in df.schema}
        from pyspark.sql.types import StructType

        order = [n for n in df.columns if n not in partition_by] + list(partition_by)
        reader = reader.schema(StructType([kinds[n] for n in order]))
    return reader.parquet(path)


def _release_at_exit(spark: SparkSession) -> None:
    """Once for each application: what it wrote is deleted when the driver's Python ends, if the application still runs then."""
    app = spark.sparkContext.applicationId
    if app in _RELEASED:
        return
    _RELEASED.add(app)

    def run() -> None:
        with suppress(Exception):  # the application may have ended, and its connection with it
            if spark.sparkContext._jsc is not None and spark.sparkContext.applicationId == app:
                release(spark)

    atexit.register(run)


def release(spark: SparkSession) -> None:
    """Delete what this application wrote into the shared folder. Call it when the results that were made from it are read or written."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tallyloom-{sc.applicationId}")
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, once for each application.

    Operators that run Python in tasks call it first, so that nothing has to be installed on the executors. The
    package's own files go through Spark's file server.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = Path(__file__).resolve().parent
    if not root.is_dir():
        return  # it runs from an archive, which was shipped already
    folder = tempfile.mkdtemp(prefix="tallyloom-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(archive)


def parallelism(spark: SparkSession) -> int:
    """Shuffle partitions of the session, the unit in which operators size what they split."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
