"""Indexing a stream of bulk actions, and time buckets over a document stream.

Write path: the stream of actions (``id, seq, action, fields...``) is appended
to an action log by Structured Streaming's file sink, which is exactly-once
through its checkpoint (a restarted query neither loses nor duplicates a
micro-batch). Readers see the table as ``apply_actions(base, log)``, the same
distributed, partially-aggregated fold used for batch feeds (merge on read).
``compact`` writes that view as a new version folder; the next log starts
empty against it. No per-id state is held in the streaming query, so a hot id
costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import write as W
from ..operators.metrics import Metric, aggregate
from ..session import checkpoint_base


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """A stable checkpoint location for stream ``name`` under the shared
    folder the cluster names in ``spark.checkpoint.dir`` (not the per-run
    subfolder Spark adds for batch checkpoints, so a restarted application
    resumes the same stream exactly once)."""
    return f"{checkpoint_base(spark).rstrip('/')}/streams/{name}"


def append_actions(feed_stream: DataFrame, log_path: str, checkpoint_location: str | None = None,
                   available_now: bool = True, processing_time: str | None = None,
                   name: str = "actions") -> StreamingQuery:
    """Start appending an action stream to the action log (Parquet). Without
    ``checkpoint_location`` the stream checkpoints under
    ``spark.checkpoint.dir`` (see :func:`stream_checkpoint`)."""
    if checkpoint_location is None:
        checkpoint_location = stream_checkpoint(feed_stream.sparkSession, name)
    w = (feed_stream.writeStream.format("parquet").outputMode("append")
         .option("path", log_path).option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def current_view(spark: SparkSession, base: DataFrame, log_path: str, id_field: str,
                 fields: Sequence[str], seq_field: str = "seq", action_field: str = "action") -> DataFrame:
    """The table as of the last committed micro-batch: base + action log."""
    log = spark.read.schema(_log_schema(base, id_field, fields, seq_field, action_field)).parquet(log_path)
    return W.apply_actions(base, log, id_field, seq_field, action_field, list(fields))


def _log_schema(base: DataFrame, id_field, fields, seq_field, action_field) -> str:
    types = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    cols = [f"`{id_field}` {types[id_field]}", f"`{seq_field}` bigint", f"`{action_field}` string"]
    cols += [f"`{c}` {types[c]}" for c in fields]
    return ", ".join(cols)


def compact(spark: SparkSession, base: DataFrame, log_path: str, out_base: str, version: str,
            id_field: str, fields: Sequence[str], seq_field: str = "seq",
            action_field: str = "action") -> str:
    """Write base + log as a new version folder and return its path."""
    view = current_view(spark, base, log_path, id_field, fields, seq_field, action_field)
    return W.save_version(view, out_base, version)


def stream_date_histogram(stream: DataFrame, ts_field: str, fixed_interval: str, watermark: str,
                          metrics: Mapping[str, Metric] | None = None) -> DataFrame:
    """Fixed-interval time buckets over a document stream. The watermark bounds
    the state: a bucket is emitted (append mode) once the watermark passes
    its end, and later documents for it are dropped as late data."""
    special = sorted(n for n, m in (metrics or {}).items() if m.special)
    if special:
        # exact percentiles / MAD / string entropy need joins and checkpoints
        # over the whole group: batch only (use approx=True sketches here)
        raise ValueError(f"metrics {special} are batch-only; use approx=True on a stream")
    # event time must be a (session-zone) TIMESTAMP; keys are returned as
    # TIMESTAMP_NTZ like the batch date_histogram
    keyed = (stream.withColumn("_t", F.col(ts_field).cast("timestamp"))
                   .withWatermark("_t", watermark)
                   .withColumn("_w", F.window(F.col("_t"), fixed_interval)))
    out = aggregate(keyed, ["_w"], metrics or {})
    return out.select(F.col("_w.start").cast("timestamp_ntz").alias("key"), *[c for c in out.columns if c != "_w"])
