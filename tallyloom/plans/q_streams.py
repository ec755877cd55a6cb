"""Queries of the streaming extension: a bounded stream run to its end, compared with the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import shared_path
from ..streaming.metrics import windowed_metrics
from .registry_helpers import book
from .tables import read

QUERIES, SQL, query = book()


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS reads, count(*) FILTER (value > 50) AS large FROM events GROUP BY 1, 2")
def x01_stream_metrics(spark, sf):
    """Hourly metrics of the events as a stream; all of it is read before the watermark could drop any."""
    schema = read(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    out = shared_path(spark, "stream")
    m = windowed_metrics(stream, "ts", "event_type", {"large": F.col("value") > 50}, late="36500 days")
    # With so long a watermark no window is ever closed, so the whole state is written once at the end.
    q = m.writeStream.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).option("checkpointLocation", shared_path(spark, "stream-state")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
