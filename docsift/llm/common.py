"""Helpers shared by the training-data operators: the shared work folder, raw
record files written by Spark's own commit protocol, and Arrow batch slicing."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, table_path

#: ASCII white space of the word rule ``[^\x20\x09-\x0D]+`` (fixed values).
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, removed when the
    application ends."""
    path = posixpath.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def write_records(df: DataFrame, column: str, path: str, terminator: bytes,
                  records_per_file: int) -> None:
    """Write one binary column as files of raw bytes: each value is followed
    by ``terminator``, and a task starts a new file after ``records_per_file``
    values. Spark's text writer does the work, so files appear through its
    commit protocol (a lost executor leaves no partial file) in any store
    Spark can write to."""
    (df.select(F.col(column).cast("string").alias("value")).write
       .option("lineSep", terminator.decode("latin-1")).option("encoding", "ISO-8859-1")
       .option("maxRecordsPerFile", records_per_file).text(path))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``path, content``. Files are bounded by their writer
    (or by the caller's rolling size), never by the table."""
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def bounded(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20
            ) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_bytes`` at most
    in each (a single longer value stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        lo = used = 0
        for i, size in enumerate(sizes.tolist()):
            if i > lo and used + size > max_bytes:
                yield batch.slice(lo, i - lo)
                lo, used = i, 0
            used += size
        yield batch.slice(lo)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``keys``, one table for each such run."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = [pc.fill_null(pc.dictionary_encode(batch.column(k)).indices, -1).to_numpy(zero_copy_only=False) for k in keys]
        cuts = [0, *(np.flatnonzero((np.diff(np.stack(codes), axis=1) != 0).any(0)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            key = tuple(batch.column(k)[lo].as_py() for k in keys)
            if held and key != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            last = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def lower_ascii(texts: pa.Array) -> pa.Array:
    """A-Z lower-cased, every other byte as it is. NULL becomes empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    raw = np.frombuffer(data or b"", np.uint8)
    out = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, pa.py_buffer(out)], offset=texts.offset)


def table_of(**columns) -> pa.RecordBatch:
    return pa.record_batch(list(columns.values()), list(columns))


def free_name(columns: list[str], base: str) -> str:
    """``base``, with underscores added until no column has that name."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base
