"""Token ids as Arrow stream files of equal-length sequences.

Layout of one file (an Arrow IPC stream, readable by any Arrow library and
memory-mappable, so a batch is a view of the file and sequence ``k`` is row
``k`` of a fixed-size list: its bytes lie at a computed place):

* ``input_ids``: fixed-size list of ``seq_len`` ids (uint16 when the
  vocabulary fits, else uint32),
* ``mask``: fixed-size list of booleans, false on the padding of a file's
  last sequence,
* ``ends``: fixed-size list of booleans, true on the last id of a document
  (the end id may also be an ordinary id, so it cannot mark the end itself),
* ``doc_ids``: ids of the documents that end in the sequence, in order,
* schema metadata: ``shard`` and ``part`` (files in this order hold the
  documents in ascending order) and ``tokens`` (ids without padding).

Every batch of a file but the last has ``batch_rows`` rows. Documents run on
from one sequence to the next; only files are padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, read_files, write_records
from .tokens import Encoder

#: End-of-stream marker of the Arrow IPC format (fixed value).
END_OF_STREAM = b"\xff\xff\xff\xff\x00\x00\x00\x00"


def _schema(width: pa.DataType, seq_len: int, meta: dict | None = None) -> pa.Schema:
    return pa.schema([("input_ids", pa.list_(width, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len)),
                      ("ends", pa.list_(pa.bool_(), seq_len)), ("doc_ids", pa.list_(pa.int64()))],
                     metadata={k: str(v) for k, v in (meta or {}).items()})


def stream_bytes(ids: np.ndarray, ends: np.ndarray, doc_ids: list, seq_len: int, vocab_size: int,
                 batch_rows: int = 256, meta: dict | None = None) -> pa.Buffer:
    """One whole stream file without its end marker. ``ends`` holds the place
    after the last id of each document."""
    width = pa.uint16() if vocab_size <= 1 << 16 else pa.uint32()
    n = len(ids)
    rows = -(-n // seq_len)
    padded = np.zeros(rows * seq_len, width.to_pandas_dtype())
    padded[:n] = ids
    mask = np.arange(rows * seq_len) < n
    last = np.zeros(rows * seq_len, bool)
    last[ends - 1] = True
    cuts = np.searchsorted(ends, np.arange(rows + 1) * seq_len, side="right")
    docs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(doc_ids, pa.int64()))
    table = pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(padded), seq_len),
                             pa.FixedSizeListArray.from_arrays(pa.array(mask), seq_len),
                             pa.FixedSizeListArray.from_arrays(pa.array(last), seq_len), docs],
                            schema=_schema(width, seq_len, (meta or {}) | {"tokens": n}))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        for lo in range(0, rows, batch_rows):
            writer.write_batch(table.slice(lo, batch_rows))
    data = sink.getvalue()
    assert data.slice(data.size - len(END_OF_STREAM)).equals(pa.py_buffer(END_OF_STREAM))
    return data.slice(0, data.size - len(END_OF_STREAM))


def write_sequences(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
                    tokenizer: str | None = None, end_id: int | None = 1, seq_len: int = 2048,
                    file_tokens: int = 8_000_000, shards: int | None = None) -> None:
    """Encode whole texts (NULL: empty), append ``end_id`` to each, and write
    the ids in ascending ``id_col`` order (NULL first; rows of one id next to
    each other, by text) as Arrow stream files under ``path``.

    Documents are range-partitioned by id, so each task encodes one run of
    the order and writes its own files of at most ``file_tokens`` ids (a
    longer document stays whole in one file). An empty table writes no file.
    Only the two named columns are read."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranged = ids.repartitionByRange(shards, "doc_id") if shards else ids.repartitionByRange("doc_id")

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, part = Encoder.of(tokenizer), TaskContext.get().partitionId(), 0
        kept, ends, names, n = [], [], [], 0
        width = np.uint16 if enc.vocab_size <= 1 << 16 else np.uint32
        tail = np.asarray([] if end_id is None else [end_id], width)

        def one() -> pa.RecordBatch:
            data = stream_bytes(np.concatenate(kept), np.asarray(ends, np.int64), names, seq_len, enc.vocab_size,
                                meta={"shard": shard, "part": part})
            place = pa.array([0, data.size], pa.int32()).buffers()[1]
            return pa.record_batch([pa.Array.from_buffers(pa.binary(), 1, [None, place, data])], ["file"])

        for batch in bounded(batches, "text"):
            flat, off = enc.encode(batch.column("text"))
            flat = flat.astype(width)
            for i, name in enumerate(batch.column("doc_id").to_pylist()):
                own = flat[off[i]: off[i + 1]]
                size = len(own) + len(tail)
                if not size:
                    continue  # without an end id an empty text holds no place
                if n and n + size > file_tokens:
                    yield one()
                    kept, ends, names, n, part = [], [], [], 0, part + 1
                kept += [own, tail]
                n += size
                ends.append(n)
                names.append(name)
        if n:
            yield one()

    made = ranged.sortWithinPartitions("doc_id", "text").mapInArrow(files, "file binary")
    write_records(made, "file", path, END_OF_STREAM, records_per_file=1)


def open_sequences(source) -> tuple[pa.Schema, list[pa.RecordBatch]]:
    """Batches of one stream file (a path, memory-mapped, or a buffer): views
    of the file's bytes, nothing is copied."""
    if isinstance(source, str):
        source = pa.memory_map(source)
    reader = pa.ipc.open_stream(source)
    return reader.schema, list(reader)


def sequence(batches: list[pa.RecordBatch], k: int) -> tuple[np.ndarray, pa.Array]:
    """Ids (a view of the file) and mask of sequence ``k`` of a file, found by
    its place: all batches but the last have as many rows as the first."""
    batch, row = divmod(k, batches[0].num_rows)
    ids, mask = batches[batch].column("input_ids"), batches[batch].column("mask")
    width = ids.type.list_size
    at = (ids.offset + row) * width
    return ids.values.to_numpy()[at: at + width], mask.values.slice(at, width)


def file_documents(source) -> tuple[dict, np.ndarray, list, np.ndarray]:
    """Metadata, ids without padding, document ids, and the place after each
    document's last id, of one stream file."""
    schema, batches = open_sequences(source)
    meta = {k.decode(): int(v) for k, v in (schema.metadata or {}).items()}
    ids = np.concatenate([b.column("input_ids").flatten().to_numpy() for b in batches])
    mask = np.concatenate([b.column("mask").flatten().to_numpy(zero_copy_only=False) for b in batches])
    last = np.concatenate([b.column("ends").flatten().to_numpy(zero_copy_only=False) for b in batches])
    names = [x for b in batches for x in b.column("doc_ids").flatten().to_pylist()]
    return meta, ids[mask], names, np.flatnonzero(last & mask) + 1


def read_sequences(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """The documents held by the stream files under ``path``: ``doc_id,
    start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``
    (of the ids as little-endian unsigned 32-bit integers) and, on request,
    ``ids`` (those bytes). Each file is read by one task; only one row per
    file meets in the running sum of file sizes."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                meta, ids, names, ends = file_documents(content.as_buffer())
                wide = ids.astype("<u4")
                starts = np.concatenate([[0], ends[:-1]])
                for lo in range(0, len(ends), 2000):
                    own = [wide[a:b].tobytes() for a, b in zip(starts[lo: lo + 2000], ends[lo: lo + 2000])]
                    cols = [pa.array([meta[k]] * len(own), pa.int64()) for k in ("shard", "part", "tokens")]
                    cols += [pa.array(names[lo: lo + 2000], pa.int64()), pa.array(starts[lo: lo + 2000], pa.int64()),
                             pa.array([len(x) // 4 for x in own], pa.int64()),
                             pa.array([zlib.crc32(x) for x in own], pa.int64())]
                    names_out = ["shard", "part", "tokens", "doc_id", "at", "n_tokens", "ids_crc32"]
                    if with_ids:
                        cols.append(pa.array(own, pa.binary()))
                        names_out.append("ids")
                    yield pa.record_batch(cols, names_out)

    kind = "shard long, part long, tokens long, doc_id long, at long, n_tokens long, ids_crc32 long"
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                meta = pa.ipc.open_stream(content.as_buffer()).schema.metadata
                yield pa.record_batch([pa.array([int(meta[k.encode()])], pa.int64()) for k in ("shard", "part", "tokens")],
                                      ["shard", "part", "tokens"])

    rows = read_files(spark, path).mapInArrow(documents, kind + (", ids binary" if with_ids else ""))
    files = read_files(spark, path).mapInArrow(sizes, "shard long, part long, tokens long")
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    base = files.select("shard", "part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    out = rows.join(base, ["shard", "part"])
    return out.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
                      "shard", "part", *(["ids"] if with_ids else []))
