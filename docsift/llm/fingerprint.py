"""Quartile bucket digests of byte triplets.

Every triplet of neighbouring bytes of the UTF-8 text is hashed into one of
128 buckets. The counts' quartiles cut them into four classes, so a bucket
takes two bits; the digest is those 256 bits and one byte for the length (on
a logarithmic scale) in hex. Two digests differ by the sum over buckets of
0, 1, 2 or 6 for 0 to 3 classes apart, plus the distance of the length bytes
(at most 64), bounded by :data:`MOST`; likeness is 1 minus the share of that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import bounded

BUCKETS = 128
#: Difference of two buckets by the classes between them.
APART = np.asarray([0, 1, 2, 6])
#: Bound of the difference score: a little over what two unrelated texts have.
MOST = 256


def classes(texts: list[bytes]) -> np.ndarray:
    """Bucket classes (0 to 3) of each text and its length byte (the last
    column). A text of under three bytes has no triplet: all classes are 0."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    out = np.zeros((len(texts), BUCKETS + 1), np.uint8)
    if len(data) >= 3:
        owner = np.repeat(np.arange(len(texts), dtype=np.int64) * BUCKETS, sizes)[:-2]
        ends = np.repeat(np.cumsum(sizes), sizes)[:-2]
        wide = data.astype(np.uint32)
        key = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
        bucket = (key * np.uint32(0x9E3779B1)) >> np.uint32(25)
        own = np.arange(len(key)) + 3 <= ends  # the triplet ends inside its text
        count = np.bincount((owner + bucket)[own], minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS)
        ranked = np.sort(count, axis=1)
        for quarter in (1, 2, 3):
            out[:, :BUCKETS] += count > ranked[:, quarter * BUCKETS // 4 - 1][:, None]
    out[:, BUCKETS] = np.minimum(255, np.rint(8 * np.log2(sizes + 1)))
    return out


def digest(row: np.ndarray) -> str:
    """Hex form of one text's classes and length byte."""
    q = row[:BUCKETS].reshape(-1, 4)
    packed = (q[:, 0] << 6) | (q[:, 1] << 4) | (q[:, 2] << 2) | q[:, 3]
    return bytes([*packed.tolist(), int(row[BUCKETS])]).hex()


def undigest(text: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(text), np.uint8)
    return np.append(((raw[:-1, None] >> np.asarray([6, 4, 2, 0], np.uint8)) & 3).ravel(), raw[-1])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness (0 to 1) of digests' classes, row by row."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    apart = APART[np.abs(a[..., :BUCKETS] - b[..., :BUCKETS])].sum(-1)
    apart = apart + np.minimum(64, np.abs(a[..., BUCKETS] - b[..., BUCKETS]))
    return 1 - np.minimum(apart, MOST) / MOST


def half_replaced(text: str, by: str) -> str:
    """The text with its last half (rounded down) replaced by the first as
    many characters (or all) of another."""
    half = len(text) // 2
    return text[: len(text) - half] + by[:half]


SCHEMA = ("part int, last boolean, doc_id long, n_chars long, fingerprint string, edited_sha256 string, "
          "edited_fingerprint string, near_edited double, near_next double, head string, tail string")
RESULT = ["doc_id", "n_chars", "fingerprint", "edited_sha256", "edited_fingerprint", "near_edited", "near_next"]


def _rows(ids: list, texts: list[str], following: list[str], part: int) -> pa.RecordBatch:
    own = classes([t.encode("utf-8", "surrogatepass") for t in texts])
    after = classes([t.encode("utf-8", "surrogatepass") for t in following])
    changed = [half_replaced(t, n).encode("utf-8", "surrogatepass") for t, n in zip(texts, following)]
    edit = classes(changed)
    n = len(texts)
    cols = {"part": pa.array([part] * n, pa.int32()), "last": pa.array([False] * n), "doc_id": pa.array(ids, pa.int64()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()), "fingerprint": pa.array([digest(r) for r in own]),
            "edited_sha256": pa.array([hashlib.sha256(c).hexdigest() for c in changed]),
            "edited_fingerprint": pa.array([digest(r) for r in edit]),
            "near_edited": pa.array(likeness(own, edit)), "near_next": pa.array(likeness(own, after)),
            "head": pa.nulls(n, pa.string()), "tail": pa.nulls(n, pa.string())}
    return pa.record_batch(list(cols.values()), list(cols))


def _mark(part: int, last: bool, doc_id, head: str | None, tail: str | None) -> pa.RecordBatch:
    row = {"part": part, "last": last, "doc_id": doc_id, "head": head, "tail": tail}
    names = [x.split() for x in SCHEMA.split(", ")]
    kinds = {"int": pa.int32(), "boolean": pa.bool_(), "long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    return pa.record_batch([pa.array([row.get(n)], kinds[k]) for n, k in names], [n for n, _ in names])


def compare_with_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text (NULL: empty) and of its edit, whose
    last half comes from the next document in ascending ``id_col`` order
    (NULL first, rows of one id by text; after the last row: the first).

    Documents are range-partitioned by id once; each task compares the
    neighbours of its run, and hands on the texts of its first and last row.
    Those (two rows of each task) meet by the task's number. A single row is
    its own next document; an empty table gives no rows."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranged = src.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), None
        for batch in bounded(batches, "text"):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            if before is None:
                yield _mark(part, False, ids[0], texts[0], None)
            else:
                ids, texts = [before[0], *ids], [before[1], *texts]
            before = ids[-1], texts[-1]
            if len(ids) > 1:
                yield _rows(ids[:-1], texts[:-1], texts[1:], part)
        if before is not None:
            yield _mark(part, True, before[0], None, before[1])

    made = cut_lineage(ranged.mapInArrow(run, SCHEMA))
    heads = made.where("head IS NOT NULL").select(F.col("part").alias("next"), "head")
    parts = heads.select(F.col("next").alias("part"))  # one short row per task
    first = F.min("part").over(Window.partitionBy())
    order = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), first).alias("next"))
    tails = made.where("last").select("part", "doc_id", "tail").join(order, "part").join(heads, "next")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "tail"):
            yield _rows(batch.column("doc_id").to_pylist(), batch.column("tail").to_pylist(),
                        batch.column("head").to_pylist(), 0)

    ends = tails.select("doc_id", "tail", "head").mapInArrow(finish, SCHEMA)
    return made.where("fingerprint IS NOT NULL").select(RESULT).unionByName(ends.select(RESULT))
