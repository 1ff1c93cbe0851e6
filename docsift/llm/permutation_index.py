"""Approximate nearest neighbours by a permutation index.

1. *Pivots.* :func:`fit` takes a bounded sample of vectors as pivots.
2. *Permutations.* Every vector is represented by its ``prefix`` nearest
   pivots, nearest first (:func:`prefixes`).
3. *Pivot inverted files.* :func:`build_index` deals all rows out to blocks of
   about ``block_rows`` rows of similar norm and writes a Parquet table with a
   row per block: its vectors and, for each pivot, the rows that have it in
   their prefix with its place there.
4. *Footrule.* :func:`search` walks the files of a query's own pivots. The
   footrule distance of two prefixes (a pivot that is missing stands at place
   ``prefix``) is a constant less twice the sum, over the shared pivots, of
   ``prefix`` minus the larger of its places, so one number is added per
   posting.
5. *Rerank.* The ``share`` of each block that is nearest by footrule is scored
   by inner product in double precision. Blocks come by falling norm, and
   those whose norm cannot beat a query's results so far are left out, which
   is exact.

Queries are cut into blocks as the index is, so neither side is ever held
whole; a task streams the index blocks of one stripe past one query block and
returns ``k`` rows for each of its queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import runs, table_of, work_path

#: Rows of an index block, queries of a query block, queries ranked at once.
BLOCK_ROWS, QUERY_ROWS, AT_ONCE = 8192, 4096, 256
#: Parts into which the index blocks are dealt; each returns ``k`` rows a query.
STRIPES = 64
#: Rows of a block that are reranked at least.
LEAST_RERANKED = 256


@dataclass(frozen=True)
class Pivots:
    """Unit vectors (rows), and the length of a permutation's prefix."""

    units: np.ndarray
    prefix: int

    @property
    def dimension(self) -> int:
        return self.units.shape[1]


def usable(vector: Column) -> Column:
    """Neither NULL, zero, nor with a component that is NULL or not finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def vectors(rows: DataFrame, id_col: str, vector_col: str, dimension: int | None = None) -> DataFrame:
    """``id, vector`` (doubles) of the usable rows."""
    out = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                      F.col(f"`{vector_col}`").cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    return out if dimension is None else out.where(F.size("vector") == dimension)


def fit(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = 1024,
        prefix: int = 64) -> Pivots | None:
    """Pivots from at most ``2 * pivots`` rows, those lowest by a hash of the
    vector (repeated vectors once). The index's dimension is the most frequent
    one, the smallest on ties. None if no vector is usable."""
    found = vectors(rows, id_col, vector_col)
    common = found.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not common:
        return None
    picked = (found.where(F.size("vector") == common[0]["d"])
              .orderBy(F.xxhash64("vector"), "vector").select("vector").limit(2 * pivots).collect())
    units = np.unique(_unit(np.asarray([r["vector"] for r in picked])), axis=0)
    units = units[np.random.default_rng(0).permutation(len(units))[:pivots]]
    return Pivots(units, min(prefix, len(units)))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow of squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def prefixes(x: np.ndarray, pivots: Pivots) -> np.ndarray:
    """Numbers of each row's nearest pivots, nearest first."""
    near = _unit(x) @ pivots.units.T
    some = np.argpartition(-near, pivots.prefix - 1, axis=1)[:, : pivots.prefix]
    order = np.argsort(-np.take_along_axis(near, some, 1), axis=1, kind="stable")
    return np.take_along_axis(some, order, 1).astype(np.int16)


def inverted_files(places: np.ndarray, pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posting lists of all pivots, one after the other: where each starts,
    and its rows and places."""
    flat = places.ravel().astype(np.int64)
    order = np.argsort(flat, kind="stable")
    starts = np.searchsorted(flat[order], np.arange(pivots + 1)).astype(np.int32)
    return starts, (order // places.shape[1]).astype(np.int32), (order % places.shape[1]).astype(np.int16)


def likeness(query_places: np.ndarray, files: tuple[np.ndarray, np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Queries by rows: the sum over shared pivots of ``prefix`` minus the
    larger place (footrule distance, turned round and halved)."""
    starts, rows, place = files
    prefix = query_places.shape[1]
    out = np.zeros((len(query_places), n), np.int16 if prefix < 256 else np.int32)  # at most prefix * (prefix + 1) / 2
    own = inverted_files(query_places, len(starts) - 1)
    for p in np.flatnonzero(np.diff(own[0]) * np.diff(starts)):
        q, qp = own[1][own[0][p]: own[0][p + 1]], own[2][own[0][p]: own[0][p + 1]]
        r, rp = rows[starts[p]: starts[p + 1]], place[starts[p]: starts[p + 1]]
        out[q[:, None], r[None, :]] += prefix - np.maximum(qp[:, None], rp[None, :])
    return out


# ------------------------------------------------------------ the index

def _norm_class(vector: Column) -> Column:
    """Half octaves of the norm."""
    top = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    scaled = F.aggregate(vector, F.lit(0.0), lambda a, x: a + (x / top) * (x / top))
    return F.floor(2 * F.log2(top) + F.log2(scaled)).cast("long")


def _packed(dealt: DataFrame, keys: list[str], pivots: Pivots, files: bool) -> DataFrame:
    """One row per block (``keys``, whole numbers) of ``id, vector`` rows: ids, vectors, permutations, and the inverted files."""
    sent = dealt.sparkSession.sparkContext.broadcast(pivots)  # at most pivots * dimension numbers
    names = ["ids", "vectors", "places", "starts", "posted", "posted_places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for rows in runs(batches, keys):
            x = rows["vector"].chunk(0).flatten().to_numpy().reshape(-1, model.dimension)
            places = prefixes(x, model)
            posted = inverted_files(places, len(model.units)) if files else (places[:0],) * 3
            # a NULL id stands as the largest number, with its row in missing
            ids = rows["id"].chunk(0).fill_null(np.iinfo(np.int64).max).to_numpy()
            missing = np.flatnonzero(rows["id"].chunk(0).is_null().to_numpy(zero_copy_only=False)).astype(np.int32)
            data = zip(names, (ids, x, places, *posted))
            yield table_of(**{k: rows[k].chunk(0)[:1] for k in keys}, n=pa.array([len(x)], pa.int32()),
                           missing=pa.array([missing.tobytes()], pa.binary()),
                           **{k: pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for k, v in data})

    sorted_rows = dealt.repartition(*keys).sortWithinPartitions(*keys, F.col("id").asc_nulls_last(), "vector")
    schema = [f"{k} long" for k in keys] + ["n int", "missing binary"] + [f"{c} binary" for c in names]
    return sorted_rows.mapInArrow(run, ", ".join(schema))


def build_index(rows: DataFrame, pivots: Pivots, path: str, *, id_col: str = "vec_id",
                vector_col: str = "embedding") -> DataFrame:
    """Index every usable row of the pivots' dimension and write the blocks
    to ``path``; returns them as read back."""
    found = vectors(rows, id_col, vector_col, pivots.dimension).withColumn("norm", _norm_class(F.col("vector")))
    # a row for each half octave of doubles at most: some thousands
    sizes = found.groupBy("norm").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("long").alias("of"))
    deal = F.pmod(F.xxhash64("id", "vector"), F.col("of"))
    dealt = found.join(F.broadcast(sizes), "norm").select("norm", deal.alias("deal"), "id", "vector")
    _packed(dealt, ["norm", "deal"], pivots, True).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


# ------------------------------------------------------------ search

def _numbers(batch: pa.RecordBatch, column: str, i: int, kind) -> np.ndarray:
    return np.frombuffer(batch.column(column)[i].as_buffer(), kind)


class Best:
    """The best ``k`` of each query so far: score falling, then id."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, places: np.ndarray, k: int):
        self.ids, self.x, self.places, self.k = ids, x, places, k
        self.found: list[list[tuple[float, int, bool]]] = [[] for _ in ids]
        self.norms = np.sqrt((x * x).sum(1))

    def least(self) -> np.ndarray:
        return np.asarray([-f[-1][0] if len(f) == self.k else -math.inf for f in self.found])

    def add(self, norm: int, ids: np.ndarray, missing: np.ndarray, x: np.ndarray, files, share: float) -> None:
        """Rank one index block for the queries that it may serve."""
        n = len(ids)
        wanted = min(n, max(LEAST_RERANKED, self.k + 1, math.ceil(share * n)))
        null = np.zeros(n, bool)
        null[missing] = True
        open_ = np.flatnonzero(self.norms * 2.0 ** ((norm + 1) / 2) * (1 + 1e-9) >= self.least())
        for lo in range(0, len(open_), AT_ONCE):
            some = open_[lo: lo + AT_ONCE]
            if wanted < n:
                rank = likeness(self.places[some], files, n).astype(np.int64) * n + np.arange(n)[::-1]  # ties: smaller ids
                near = np.argpartition(-rank, wanted - 1, axis=1)[:, :wanted]
            else:
                near = np.broadcast_to(np.arange(n), (len(some), n))
            for q, rows in zip(some.tolist(), near):
                rows = rows[(ids[rows] != self.ids[q]) | null[rows]]
                score = x[rows] @ self.x[q]
                if len(rows) > self.k:  # a margin above rounding, then the exact order
                    bound = np.partition(score, len(score) - self.k)[-self.k]
                    rows = rows[score >= bound - 1e-9 * abs(bound) - 1e-12 * self.norms[q]]
                exact = [(-math.fsum((x[r] * self.x[q]).tolist()), int(ids[r]), bool(null[r])) for r in rows.tolist()]
                self.found[q] = sorted(self.found[q] + exact, key=lambda e: (e[0], e[2], e[1]))[: self.k]


def search(index: DataFrame, queries: DataFrame, pivots: Pivots, *, id_col: str = "vec_id",
           vector_col: str = "embedding", k: int = 20, share: float = 0.15) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each usable query the ``k`` rows
    of the index found nearest by inner product, ties by id (NULL last). Rows
    with the query's id are its own and left out; queries with one id and
    different vectors are ranked apart, repeated ones once. ``share`` of each
    block is reranked; with ``share=1`` the result is exact."""
    found = vectors(queries, id_col, vector_col, pivots.dimension).where("id IS NOT NULL").dropDuplicates(["id", "vector"])
    blocks = F.pmod(F.xxhash64("id", "vector"), F.lit(max(1, -(-found.count() // QUERY_ROWS))))
    asked = _packed(found.select(blocks.alias("ask"), "id", "vector"), ["ask"], pivots, False)
    stripe = F.pmod(F.xxhash64("norm", "deal"), F.lit(STRIPES)).cast("int")
    asks = asked.select("ask")
    # a stated query set in blocks against the index in blocks: every unit is
    # one query block and one stripe
    stripes = index.select(stripe.alias("stripe")).distinct()
    left = asked.join(stripes).select("stripe", "ask", F.lit(None).cast("long").alias("norm"), F.lit(None).cast("long").alias("deal"),
                                      *[c for c in asked.columns if c != "ask"])
    right = index.withColumn("stripe", stripe).join(asks).select(*left.columns)
    units = left.union(right).repartition("stripe", "ask").sortWithinPartitions(
        "stripe", "ask", F.col("norm").desc_nulls_first(), "deal")
    dimension, prefix = pivots.dimension, pivots.prefix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None

        def done() -> pa.RecordBatch:
            rows = [(int(q), hit, place) for place, q in enumerate(best.ids) for hit in best.found[place]]
            return table_of(query_id=pa.array([r[0] for r in rows], pa.int64()),
                            vector=pa.array([best.x[r[2]].tobytes() for r in rows], pa.binary()),
                            vec_id=pa.array([None if r[1][2] else r[1][1] for r in rows], pa.int64()),
                            score=pa.array([-r[1][0] + 0.0 for r in rows], pa.float64()))

        for batch in batches:
            for i in range(batch.num_rows):
                ids = _numbers(batch, "ids", i, np.int64)
                x = _numbers(batch, "vectors", i, np.float64).reshape(-1, dimension)
                if not batch.column("norm")[i].is_valid:  # a unit begins with its queries
                    if best is not None:
                        yield done()
                    best = Best(ids, x, _numbers(batch, "places", i, np.int16).reshape(-1, prefix), k)
                    continue
                files = tuple(_numbers(batch, c, i, t) for c, t in (
                    ("starts", np.int32), ("posted", np.int32), ("posted_places", np.int16)))
                best.add(batch.column("norm")[i].as_py(), ids, _numbers(batch, "missing", i, np.int32), x, files, share)
        if best is not None:
            yield done()

    hits = units.mapInArrow(run, "query_id long, vector binary, vec_id long, score double")
    # at most k rows of a query from each stripe
    order = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def neighbours(rows: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
               k: int = 20, share: float = 0.15, pivots: int = 1024, prefix: int = 64) -> DataFrame:
    """Fit, index and search in one call. Only the id and the vector are read,
    so other columns may have any name. NULL or zero vectors, vectors with a
    NULL or non-finite component, and vectors of another length than the most
    frequent one take no part; an empty table gives no rows."""
    spark = rows.sparkSession
    model = fit(rows, id_col=id_col, vector_col=vector_col, pivots=pivots, prefix=prefix)
    if model is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = build_index(rows, model, work_path(spark, "pivot-index"), id_col=id_col, vector_col=vector_col)
    return search(index, queries, model, id_col=id_col, vector_col=vector_col, k=k, share=share)
