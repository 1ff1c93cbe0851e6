"""Tables that change by buckets, with versions.

A table is a folder. Rows lie in ``buckets`` hash buckets of their id; each
write puts the new state of the buckets it touches into a data folder of its
own, and nothing that a version refers to is ever changed. A version is a
small table that names, for each bucket, the data folder that holds it. So an
upsert, a delete by id or an action feed reads and writes the buckets of its
ids only, readers of a version are not disturbed, and an older version can be
read as long as it is kept.

A version is published by creating a file named by its number, which only one
writer can do: a change made to a state that is no longer the latest is
refused with :class:`StaleVersion`, and its data is never referred to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.mapping import clean_field_names
from . import write as W

#: Column of the data folders; documents cannot have a field of this name.
BUCKET = "_bucket"


class StaleVersion(RuntimeError):
    """Another change was published after the state that this one is based on."""


def _files(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    fs, hpath = _files(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(hpath)] if fs.exists(hpath) else []


@dataclass
class BucketedTable:
    """One version of a table. Changes return the next version."""
    spark: SparkSession
    path: str
    version: int
    id_field: str
    buckets: int
    schema: T.StructType
    folders: dict[int, str] = field(repr=False)  # bucket -> data folder

    # ------------------------------------------------------------ versions

    @classmethod
    def create(cls, df: DataFrame, path: str, id_field: str = "id", buckets: int = 64) -> "BucketedTable":
        """Write ``df`` as version 0. Size ``buckets`` so that a bucket is a
        few hundred MB. Repeated or NULL ids fail the write."""
        none = cls(df.sparkSession, path.rstrip("/"), -1, id_field, buckets, df.schema, {})
        if none.versions():
            raise FileExistsError(f"a table exists at {path}")
        return none._publish(df, range(buckets))

    @classmethod
    def open(cls, spark: SparkSession, path: str, version: int | None = None) -> "BucketedTable":
        """The latest version, or the one asked for."""
        path = path.rstrip("/")
        probe = cls(spark, path, -1, "", 0, T.StructType(), {})
        found = probe.versions()
        if not found:
            raise FileNotFoundError(f"no table at {path}")
        version = found[-1] if version is None else version
        if version not in found:
            raise FileNotFoundError(f"no version {version} at {path}")
        said = json.loads(spark.read.text(f"{path}/versions/{version}").first()[0])
        rows = spark.read.parquet(f"{path}/manifests/{said['manifest']}").collect()  # one row per bucket
        return cls(spark, path, version, said["id_field"], said["buckets"], T.StructType.fromJson(said["schema"]),
                   {r["bucket"]: r["folder"] for r in rows})

    def versions(self) -> list[int]:
        """Numbers of the published versions."""
        fs, hpath = _files(self.spark, f"{self.path}/versions")
        if not fs.exists(hpath):
            return []
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(hpath) if f.getPath().getName().isdigit() and f.getLen() > 0)

    def at(self, version: int) -> "BucketedTable":
        return BucketedTable.open(self.spark, self.path, version)

    # ------------------------------------------------------------ reading

    @property
    def df(self) -> DataFrame:
        return self._read(self.folders)

    def _read(self, buckets: Iterable[int]) -> DataFrame:
        """The rows of some buckets; no other file is listed or opened."""
        paths = [f"{self.path}/data/{self.folders[b]}/{BUCKET}={b}" for b in sorted(buckets) if b in self.folders]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _bucket(self, df: DataFrame):
        # one hash for all widths of whole numbers
        kind = df.schema[self.id_field].dataType
        value = F.col(f"`{self.id_field}`")
        return F.pmod(F.xxhash64(value.cast("long") if isinstance(kind, T.IntegralType) else value.cast("string")), F.lit(self.buckets)).cast("int")

    def get(self, ids: Iterable) -> DataFrame:
        """Documents by id, from their buckets."""
        ids = self.spark.createDataFrame([(str(i),) for i in ids], "i string").select(
            F.col("i").cast(self.schema[self.id_field].dataType).alias(self.id_field)).distinct()
        return self._read(self._touched(ids)).join(ids, self.id_field, "left_semi")

    def _touched(self, ids: DataFrame) -> list[int]:
        """Buckets of some ids: at most ``buckets`` numbers."""
        return sorted(r[0] for r in ids.select(self._bucket(ids).alias("b")).distinct().collect())

    # ------------------------------------------------------------ changes

    def upsert(self, new: DataFrame, order_field: str | None = None, clean_names: bool = True) -> "BucketedTable":
        """Replace documents by id and add the others
        (:func:`docsift.operators.write.upsert`)."""
        if clean_names:
            new = clean_field_names(new)
        kind = self.schema[self.id_field].dataType
        own = F.col(f"`{self.id_field}`") if self.id_field in new.columns else F.lit(None)
        new = new.withColumn(self.id_field, own.cast(kind))
        if new.schema[self.id_field].nullable:
            new = W.assign_ids(new, self.id_field)
        new = new.withColumn(self.id_field, F.col(f"`{self.id_field}`").cast(kind))
        return self._change(new, lambda old: W.upsert(old, new, self.id_field, order_field, clean_names=False))

    def delete(self, ids: Iterable | DataFrame) -> "BucketedTable":
        """Remove documents by id; unknown ids are ignored."""
        if not isinstance(ids, DataFrame):
            kind = self.schema[self.id_field].dataType
            ids = self.spark.createDataFrame([(str(i),) for i in ids], "i string").select(F.col("i").cast(kind).alias(self.id_field))
        return self._change(ids, lambda old: W.delete_ids(old, ids, self.id_field))

    def apply(self, feed: DataFrame, **options) -> "BucketedTable":
        """Apply a feed of bulk actions
        (:func:`docsift.operators.write.apply_actions`)."""
        return self._change(feed, lambda old: W.apply_actions(old, feed, self.id_field, **options))

    def _change(self, ids: DataFrame, state: Callable[[DataFrame], DataFrame]) -> "BucketedTable":
        touched = self._touched(ids)
        return self._publish(state(self._read(touched)), touched) if touched else self

    def _publish(self, rows: DataFrame, touched: Iterable[int]) -> "BucketedTable":
        """Write the new state of some buckets and name it the next version."""
        if BUCKET in rows.columns:
            raise ValueError(f"a field cannot be called {BUCKET}")
        if self.versions()[-1:] not in ([], [self.version]):
            raise StaleVersion(f"version {self.version} of {self.path} is not the latest")
        folder = uuid.uuid4().hex
        own = F.col(f"`{self.id_field}`")
        # a bucket is written by one task; its ids are side by side there
        twice = F.count(F.lit(1)).over(Window.partitionBy(BUCKET, self.id_field)) > 1
        bad = F.raise_error(F.concat(F.lit("ids must be unique and not NULL: "), F.coalesce(own.cast("string"), F.lit("NULL"))))
        checked = F.when(twice | own.isNull(), bad.cast(rows.schema[self.id_field].dataType)).otherwise(own)
        dealt = rows.withColumn(BUCKET, F.coalesce(self._bucket(rows), F.lit(0))).repartition(BUCKET)
        out = dealt.withColumn("_checked", checked).withColumn(self.id_field, F.col("_checked")).drop("_checked")
        out.write.partitionBy(BUCKET).parquet(f"{self.path}/data/{folder}")
        made = {int(n.split("=")[1]) for n in _names(self.spark, f"{self.path}/data/{folder}") if n.startswith(f"{BUCKET}=")}
        gone = set(touched)
        folders = {b: f for b, f in self.folders.items() if b not in gone} | dict.fromkeys(made, folder)
        self.spark.createDataFrame(sorted(folders.items()), "bucket int, folder string").coalesce(1).write.parquet(
            f"{self.path}/manifests/{folder}")
        said = json.dumps({"manifest": folder, "id_field": self.id_field, "buckets": self.buckets, "schema": json.loads(rows.schema.json())})
        self._name(self.version + 1, said)
        return BucketedTable(self.spark, self.path, self.version + 1, self.id_field, self.buckets, rows.schema, folders)

    def _name(self, version: int, said: str) -> None:
        """Create the version's file, unless there is one."""
        fs, hpath = _files(self.spark, f"{self.path}/versions/{version}")
        fs.mkdirs(hpath.getParent())
        try:
            stream = fs.create(hpath, False)
        except Exception as e:
            if fs.exists(hpath):
                raise StaleVersion(f"version {version} of {self.path} was published by another writer") from e
            raise
        stream.write(bytearray((said + "\n").encode()))
        stream.close()

