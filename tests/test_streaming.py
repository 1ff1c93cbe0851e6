import os
import tempfile

from pyspark.sql import functions as F

from docsift.operators import buckets as B
from docsift.operators import metrics as M
from docsift.operators import write as W
from docsift.streaming import indexing as S

SF = "/root/testdata/sf0.001"


def _feed(df):
    action = (F.when(F.col("event_type") == "view", "index").when(F.col("event_type") == "click", "update")
               .when(F.col("event_type") == "purchase", "create").when(F.col("event_type") == "error", "delete")
               .otherwise("update"))
    return df.select((F.col("user_id") + 100).alias("c_custkey"), F.col("event_id").alias("seq"),
                     action.alias("action"),
                     F.when(action.isin("index", "create"), F.concat(F.lit("U"), F.col("event_id").cast("string")))
                      .alias("c_name"),
                     F.col("value").alias("c_acctbal"))


def test_stream_of_actions_equals_batch(spark):
    work = tempfile.mkdtemp(prefix="docsift-stream-")
    events = spark.read.parquet(f"{SF}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    q = S.append_actions(_feed(stream), os.path.join(work, "log"), os.path.join(work, "ckpt"))
    q.awaitTermination(300)
    base = spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey", "c_name", "c_acctbal")
    got = S.current_view(spark, base, os.path.join(work, "log"), "c_custkey", ["c_name", "c_acctbal"])
    want = W.apply_actions(base, _feed(events), "c_custkey", fields=["c_name", "c_acctbal"])
    assert sorted(got.collect()) == sorted(want.collect())
    path = S.compact(spark, base, os.path.join(work, "log"), os.path.join(work, "table"), "1",
                     "c_custkey", ["c_name", "c_acctbal"])
    assert spark.read.parquet(path).count() == want.count()


def test_stream_date_histogram_equals_batch(spark):
    work = tempfile.mkdtemp(prefix="docsift-stream-")
    events = spark.read.parquet(f"{SF}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    agg = S.stream_date_histogram(stream, "ts", "6 hours", "1 hour", {"total": M.sum_("value")})
    q = (agg.writeStream.format("memory").queryName("docsift_hist").outputMode("complete")
            .option("checkpointLocation", os.path.join(work, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {(r.key, r.doc_count, round(r.total, 6)) for r in spark.table("docsift_hist").collect()}
    batch = B.date_histogram("ts", fixed_interval="6 hours", metrics={"total": M.sum_("value")}).run(events)
    want = {(r.key, r.doc_count, round(r.total, 6)) for r in batch.collect()}
    assert got == want


def test_stream_refuses_batch_only_metrics(spark):
    import pytest

    events = spark.read.parquet(f"{SF}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    with pytest.raises(ValueError):
        S.stream_date_histogram(stream, "ts", "6 hours", "1 hour", {"p": M.percentiles("value", [50])})
    # the sketch form is a plain aggregate and streams
    S.stream_date_histogram(stream, "ts", "6 hours", "1 hour", {"p": M.percentiles("value", [50], approx=True)})


def test_stream_checkpoint_is_stable_under_shared_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        import pytest
        pytest.skip("no spark.checkpoint.dir in this environment")
    a = S.stream_checkpoint(spark, "feed")
    assert a == S.stream_checkpoint(spark, "feed") and a.startswith(base.rstrip("/"))
