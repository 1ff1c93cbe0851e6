"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job needs for correct and scalable plans.
#  * UTC so timestamp buckets and parsing do not depend on the host zone.
#  * AQE re-plans at runtime: it coalesces small shuffle partitions, turns
#    sort-merge joins into broadcast joins once the real size of a side is
#    known (so no side is broadcast on a guess), and splits skewed join
#    partitions (a hot id holding a third of all rows).
#  * Checkpoint files (lineage cuts of range-sliced ranking) are removed once
#    the frames that use them are gone.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "docsift", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's base configuration.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (roughly input bytes / 128 MB).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per
    application (Spark's file server hands it out, no shared folder is
    needed). Functions that run in workers import it from there."""
    sc = spark.sparkContext
    if getattr(sc, "_docsift_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="docsift-pkg-"), "docsift-package")
    with zipfile.ZipFile(base + ".zip", "w") as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(base + ".zip")
    sc._docsift_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of this application: Spark derives it
    from the shared folder the cluster names in ``spark.checkpoint.dir``.
    When that is unset, a ``local`` master (driver and executors are one
    process, as in tests) gets a temporary folder; on a cluster this raises,
    as executors cannot read each other's folders."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            path = tempfile.mkdtemp(prefix="docsift-ckpt-")
        sc.setCheckpointDir(path)
        _delete_on_exit(spark, sc.getCheckpointDir())  # this application's own subfolder
    return sc.getCheckpointDir()


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder itself (stable across applications), for state that
    must survive a restart, such as stream checkpoints."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    return checkpoint_dir(spark).rstrip("/").rsplit("/", 1)[0]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives the
    loss of any executor, unlike a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, removed when the
    application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _delete_on_exit(spark, path)
    return path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
