"""A text index as tables: postings by term, kept up to date by segments.

``build`` writes three Parquet tables below one path:

* ``postings``: a row for each (term, slice of documents) with the documents'
  ids, the term's frequency and places in each, their lengths, and the block's
  largest frequency and smallest length; several such rows, each of other
  documents, where a task's share is too much to merge at once. Partitioned by ``bucket`` (a hash of
  the term) and sorted by term, so a query opens its own terms' buckets only and
  Parquet skips row groups of other terms. Slices are hashes of the document
  id: a term that a third of all documents hold is as many rows as there are
  slices, written by many tasks.
* ``documents``: id and number of tokens; ``gone``: ids that a later segment
  replaces or removes; ``segments``: one row per finished segment, written
  last, with the collection's changed totals.

Changes are added as a segment of the changed documents alone
(:meth:`PostingsIndex.refresh` takes a feed of bulk actions); a posting is
dead if a later segment lists its document as gone. :meth:`compact` writes all
live postings as one segment of a new index.

Ranking skips what cannot reach the result. The block numbers bound a term's
part in any score of a slice, so a first round scores the slices of the
highest bounds, whose k-th best score is a bar; the second round reads those
slices whose bound reaches it. The result is that of scoring everything.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import analyze, tokens
from ..session import ship_package
from .text import BM25_B, BM25_K1
from .write import apply_actions

#: Slices that are named in the scan's filter; more are joined.
NAMED_SLICES = 1000
#: Tasks that share one bucket when postings are written, at least.
FAN = 16
#: Slices that such a task writes at most: a larger index has more of them.
DEALT_SLICES = 16
#: Tokens that a task sorts and packs at once (some 100 MB).
PACKED_TOKENS = 1 << 20
#: Tokens whose packed rows are merged at once (some 150 MB).
MERGED_TOKENS = 1 << 20
#: Bytes of the Arrow batches that these tasks read (Spark's own limit: 64 MB).
BATCH_BYTES = 16 << 20


def _lists(values: pa.Array, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places ``start, start + 1, ...`` of runs, one run after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of numbers as bytes."""
    offsets = pa.array((np.concatenate([[0], ends]) * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, offsets.buffers()[1], pa.py_buffer(np.ascontiguousarray(values))])


def pack(batch: pa.RecordBatch, buckets: int, deals: int = FAN) -> pa.RecordBatch:
    """Postings of a batch of ``id, slice, tokens`` rows, a row for each
    (bucket, deal): its documents, its terms, how many entries each has, and the
    entries one after the other: the document's number in the row, how often
    the term occurs and where, in 2 bytes each, 4 where a text or the batch is
    too long for that."""
    lists = batch.column("tokens")
    length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    words, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(length)), length)
    place = _spread(np.zeros(len(length), np.int64), length)
    slice_ = batch.column("slice").to_numpy()
    bucket = np.asarray([zlib.crc32(w.encode()) % buckets for w in words.to_pylist()], np.int64)
    group = bucket[code] * deals + slice_[doc] % deals
    order = np.lexsort((doc, code, group))  # stable: places stay in order
    key = np.stack([group[order], code[order], doc[order]])
    first = np.flatnonzero(np.r_[True, (np.diff(key, axis=1) != 0).any(0)]) if len(order) else np.zeros(0, np.int64)
    tf = np.diff(np.r_[first, len(order)])
    group, code, doc = key[:, first]
    run = np.flatnonzero(np.r_[True, (np.diff(group) != 0) | (np.diff(code) != 0)]) if len(first) else first
    head = np.flatnonzero(np.r_[True, np.diff(group) != 0]) if len(first) else first
    ends = np.r_[head[1:], len(first)][: len(head)]
    ints = lambda x: pa.array(x.astype(np.int32))
    runs_end = np.searchsorted(run, ends)
    # the documents of each group, and the place of an entry's document among them
    pair, own = np.unique(group * max(len(length), 1) + doc, return_inverse=True)
    of, held = np.divmod(pair, max(len(length), 1))
    from_ = np.searchsorted(of, group[head])
    docs_end = np.r_[from_[1:], len(pair)][: len(head)]
    number = own - np.repeat(from_, ends - head)
    small = np.uint16 if max(length.max(initial=0), len(length)) < 1 << 16 else np.uint32
    columns = {
        "bucket": ints(group[head] // deals), "deal": ints(group[head] % deals),
        "terms": _lists(words.take(pa.array(code[run])).cast(pa.string()), runs_end),
        "counts": _lists(ints(np.diff(np.r_[run, len(first)])), runs_end),
        "ids": _lists(batch.column("id").take(pa.array(held)), docs_end), "slices": _lists(ints(slice_[held]), docs_end),
        "lengths": _lists(ints(length[held]), docs_end), "width": pa.array([np.dtype(small).itemsize] * len(head), pa.int32()),
        "docs": _binaries(number.astype(small), ends), "tfs": _binaries(tf.astype(small), ends),
        "places": _binaries(place[order].astype(small), np.r_[first[ends[:-1]], len(order)] if len(head) else ends)}
    return pa.record_batch(list(columns.values()), list(columns))


def merge(rows: pa.Table) -> pa.RecordBatch:
    """The blocks of packed rows of one (bucket, deal)."""
    flat = {c: pa.concat_arrays([x.flatten() for x in rows[c].chunks]) for c in ("terms", "counts", "ids", "slices", "lengths")}
    kinds = [np.dtype(f"u{w}") for w in rows["width"].to_pylist()]
    numbers = {c: [np.frombuffer(x.as_buffer(), k) for x, k in zip(rows[c], kinds)] for c in ("docs", "tfs", "places")}
    before = np.cumsum([0, *pc.list_value_length(rows["ids"]).to_pylist()])
    doc = np.concatenate([x.astype(np.int64) + b for x, b in zip(numbers["docs"], before)])
    tf = np.concatenate(numbers["tfs"]).astype(np.int64)
    place = np.concatenate([x.astype(np.int32) for x in numbers["places"]])
    counts, slice_, length = (flat[c].to_numpy() for c in ("counts", "slices", "lengths"))
    ids = flat["ids"].take(pa.array(doc))
    coded = flat["terms"].dictionary_encode()
    by_name = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(by_name), np.int64)
    rank[by_name] = np.arange(len(by_name))
    term = np.repeat(rank[coded.indices.to_numpy()], counts)
    keys = pa.table({"t": term, "s": slice_[doc], "i": ids})
    order = pc.sort_indices(keys, [("t", "ascending"), ("s", "ascending"), ("i", "ascending")]).to_numpy()
    term, doc = term[order], doc[order]
    slice_, length = slice_[doc], length[doc]
    start = np.flatnonzero(np.r_[True, (np.diff(term) != 0) | (np.diff(slice_) != 0)])
    ends = np.r_[start[1:], len(order)]
    at = (np.cumsum(tf) - tf)[order]
    tf = tf[order]
    places = pa.array(place[_spread(at, tf)])
    ints = lambda x: pa.array(x.astype(np.int32))
    columns = {
        "bucket": pa.array([rows["bucket"][0].as_py()] * len(start), pa.int32()),
        "term": coded.dictionary.take(pa.array(by_name[term[start]])), "slice": ints(slice_[start]), "n": ints(ends - start),
        "top_tf": ints(np.maximum.reduceat(tf, start)), "least_length": ints(np.minimum.reduceat(length, start)),
        "ids": _lists(ids.take(pa.array(order)), ends), "tfs": _lists(ints(tf), ends), "lengths": _lists(ints(length), ends),
        "places": _lists(_lists(places, np.cumsum(tf)), ends)}
    return pa.record_batch(list(columns.values()), list(columns))


def _blocks(docs: DataFrame, buckets: int, slices: int) -> DataFrame:
    """The blocks of ``id, text`` rows. Texts are split by the same expression
    as everywhere; tasks then sort Arrow batches of tokens, and what is
    shuffled is packed by (bucket, deal). Deals are as many as the slices ask
    for, and a (bucket, deal) of more than ``MERGED_TOKENS`` tokens is merged in
    parts, each with blocks of its own documents: what a task holds does not
    grow with the collection."""
    kind = docs.schema["id"].dataType.simpleString()
    deals = max(FAN, -(-slices // DEALT_SLICES))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy()
            part = (np.cumsum(size, dtype=np.int64) - 1) // PACKED_TOKENS
            cuts = np.r_[0, np.flatnonzero(np.diff(part) > 0) + 1, batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo < hi:
                    yield pack(batch.slice(lo, hi - lo), buckets, deals)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, size = [], None, 0
        for batch in batches:  # sorted by bucket and deal
            at = np.stack([batch.column(c).to_numpy() for c in ("bucket", "deal")], 1) if batch.num_rows else np.zeros((0, 2))
            upto = np.r_[0, np.cumsum(pc.binary_length(batch.column("places")).to_numpy() // batch.column("width").to_numpy(), dtype=np.int64)]
            part = (upto[1:] - 1) // MERGED_TOKENS
            cuts = np.r_[0, np.flatnonzero((np.diff(at, axis=0) != 0).any(1) | (np.diff(part) > 0)) + 1, len(at)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                more = int(upto[hi] - upto[lo])
                if held and (tuple(at[lo]) != now or size + more > MERGED_TOKENS):
                    yield merge(pa.Table.from_batches(held))
                    held, size = [], 0
                now = tuple(at[lo])
                held.append(batch.slice(lo, hi - lo))
                size += more
        if held:
            yield merge(pa.Table.from_batches(held))

    slice_ = F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int").alias("slice")
    rows = docs.select("id", slice_, tokens("text").alias("tokens"))
    rows = rows.mapInArrow(packed, f"bucket int, deal int, terms array<string>, counts array<int>, ids array<{kind}>, slices array<int>, "
                                   "lengths array<int>, width int, docs binary, tfs binary, places binary")
    return rows.repartition("bucket", "deal").sortWithinPartitions("bucket", "deal").mapInArrow(
        merged, f"bucket int, term string, slice int, n int, top_tf int, least_length int, ids array<{kind}>, tfs array<int>, "
                "lengths array<int>, places array<array<int>>")


@dataclass
class PostingsIndex:
    """Opened with the path that :meth:`build` wrote to."""
    spark: SparkSession
    path: str

    # ------------------------------------------------------------ writing

    @classmethod
    def build(cls, docs: DataFrame, path: str, text_field: str, id_field: str = "id", buckets: int = 64,
              slice_docs: int = 4096) -> "PostingsIndex":
        """Index a table. Ids must be unique and not NULL (else the build
        fails); a NULL text has no tokens. ``slice_docs``: documents of a
        slice, so rows of a block at most, about."""
        ship_package(docs.sparkSession)
        index = cls(docs.sparkSession, path)
        rows = _named(docs, id_field, text_field)
        slices = max(1, -(-rows.count() // slice_docs))
        index._write(rows, rows.select("id").limit(0), 0, buckets, slices)
        return index

    def refresh(self, base: DataFrame, feed: DataFrame, text_field: str, id_field: str = "id", **options) -> None:
        """Bring the index of ``base`` to the state after a feed of bulk
        actions (:func:`docsift.operators.write.apply_actions`). Only the
        documents that the feed names are read and indexed."""
        touched = feed.select(id_field).distinct()
        after = apply_actions(base.join(touched, id_field, "left_semi"), feed, id_field, **options)
        self.add(after, touched, text_field, id_field)

    def add(self, docs: DataFrame, gone: DataFrame, text_field: str, id_field: str = "id") -> None:
        """One more segment: ``docs`` as they are now, after the documents
        named in ``gone`` (old states of ``docs`` among them) were taken out."""
        ship_package(self.spark)
        last = self._segments()[-1]
        new = _named(docs, id_field, text_field)
        ids = gone.select(F.col(f"`{id_field}`").alias("id")).union(new.select("id")).distinct()
        self._write(new, ids, last["segment"] + 1, last["buckets"], last["slices"])

    def _write(self, rows: DataFrame, gone: DataFrame, segment: int, buckets: int, slices: int) -> None:
        at = lambda table: f"{self.path.rstrip('/')}/{table}/segment={segment}"
        blocks = _blocks(rows, buckets, slices)
        with _batches_of(self.spark, BATCH_BYTES):
            blocks.sortWithinPartitions("bucket", "term", "slice").write.mode("overwrite").partitionBy("bucket").parquet(at("postings"))
        sized = rows.select("id", F.size(tokens("text")).alias("length"))
        sized.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.first("length").alias("length")).select(
            F.when((F.col("n") == 1) & F.col("id").isNotNull(), F.col("id")).otherwise(
                F.raise_error(F.lit("ids must be unique and not NULL")).cast(rows.schema["id"].dataType)).alias("id"),
            "length").write.mode("overwrite").parquet(at("documents"))
        count = [F.count(F.lit(1)).alias("docs"), F.count("length").alias("texts"), F.coalesce(F.sum("length"), F.lit(0)).alias("tokens")]
        new = self.spark.read.parquet(at("documents")).agg(*count).first()
        old = {c: 0 for c in ("docs", "texts", "tokens")}
        if segment:
            gone.write.mode("overwrite").parquet(at("gone"))
            old = self.documents().join(self.spark.read.parquet(at("gone")), "id", "left_semi").agg(*count).first()
        kind = rows.schema["id"].dataType.simpleString()
        row = (segment, buckets, slices, kind, *(new[c] - old[c] for c in ("docs", "texts", "tokens")))
        self.spark.createDataFrame([row], "segment int, buckets int, slices int, kind string, docs long, texts long, tokens long").coalesce(1) \
            .write.mode("append").parquet(f"{self.path.rstrip('/')}/segments")

    def compact(self, path: str) -> "PostingsIndex":
        """All live postings as one segment of a new index at ``path``."""
        out, last = PostingsIndex(self.spark, path), self._segments()[-1]
        entry = F.struct("id", "tf", "length", "places")
        keep = self._live(self._postings(), places=True).withColumn("deal", F.pmod("slice", F.lit(FAN))).repartition("bucket", "deal")
        blocks = keep.groupBy("bucket", "deal", "term", "slice").agg(F.sort_array(F.collect_list(entry)).alias("e")).select(
            "bucket", "term", "slice", F.size("e").alias("n"), F.array_max("e.tf").alias("top_tf"), F.array_min("e.length").alias("least_length"),
            F.col("e.id").alias("ids"), F.col("e.tf").alias("tfs"), F.col("e.length").alias("lengths"), F.col("e.places").alias("places"))
        blocks.sortWithinPartitions("bucket", "term", "slice").write.partitionBy("bucket").parquet(f"{path}/postings/segment=0")
        self.documents().write.parquet(f"{path}/documents/segment=0")
        total = self.totals()
        row = (0, last["buckets"], last["slices"], last["kind"], *total)
        self.spark.createDataFrame([row], "segment int, buckets int, slices int, kind string, docs long, texts long, tokens long").coalesce(1) \
            .write.parquet(f"{path}/segments")
        return out

    # ------------------------------------------------------------ reading

    def _segments(self) -> list:
        """The finished segments in order (a few numbers each)."""
        return self.spark.read.parquet(f"{self.path.rstrip('/')}/segments").orderBy("segment").collect()

    def totals(self) -> tuple[int, int, int]:
        """Documents, those with a text, and tokens of the collection."""
        found = self._segments()
        return tuple(sum(s[c] for s in found) for c in ("docs", "texts", "tokens"))

    def _table(self, name: str, schema: str) -> DataFrame:
        done = [s["segment"] for s in self._segments()]
        read = self.spark.read.schema(f"{schema}, segment int").parquet(f"{self.path.rstrip('/')}/{name}")
        return read.where(F.col("segment").isin(done))

    def _kind(self) -> str:
        return self._segments()[-1]["kind"]

    def _postings(self) -> DataFrame:
        kind = self._kind()
        return self._table("postings", f"term string, slice int, n int, top_tf int, least_length int, ids array<{kind}>, "
                                       "tfs array<int>, lengths array<int>, places array<array<int>>, bucket int")

    def _dead(self, rows: DataFrame) -> DataFrame:
        """Rows with ``id`` and ``segment`` without those that a later segment
        takes out."""
        if len(self._segments()) == 1:
            return rows
        gone = self._table("gone", f"id {self._kind()}").groupBy("id").agg(F.max("segment").alias("until"))
        gone = gone.withColumnRenamed("id", "gone_id")
        return rows.join(gone, (F.col("id") == F.col("gone_id")) & (F.col("segment") < F.col("until")), "left_anti")

    def documents(self) -> DataFrame:
        """``id, length`` of the live documents."""
        return self._dead(self._table("documents", f"id {self._kind()}, length int")).select("id", "length")

    def _rows(self, words: Sequence[str]) -> DataFrame:
        """Blocks of these terms: partition and pushed filters."""
        buckets = self._segments()[-1]["buckets"]
        own = sorted({zlib.crc32(w.encode()) % buckets for w in words})
        return self._postings().where(F.col("bucket").isin(own) & F.col("term").isin(list(words)))

    def _live(self, blocks: DataFrame, places: bool = False) -> DataFrame:
        """A row for each live posting."""
        columns = {"id": "ids", "tf": "tfs", "length": "lengths"} | ({"places": "places"} if places else {})
        zipped = F.arrays_zip(*[F.col(c).alias(n) for n, c in columns.items()])
        return self._dead(blocks.select("bucket", "term", "slice", "segment", F.inline(zipped)))

    def _frequencies(self, blocks: DataFrame) -> DataFrame:
        """``term, df``: documents that hold it."""
        if len(self._segments()) == 1:
            return blocks.groupBy("term").agg(F.sum("n").cast("long").alias("df"))
        return self._live(blocks).groupBy("term").agg(F.count(F.lit(1)).alias("df"))

    # ------------------------------------------------------------ queries

    def bm25_top_k(self, text: str, k: int, min_score: float = 0.0, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
        """``id, score`` of the best ``k`` documents, ties by id: the result of
        :func:`docsift.operators.text.bm25_top_k` without reading a text."""
        words = list(dict.fromkeys(analyze(text)))
        docs, texts, total = self.totals()
        mean = total / texts if total else 1.0
        rows = self._rows(words)
        df = {r["term"]: r["df"] for r in self._frequencies(rows).collect()}  # one row per word
        idf = [math.log(1.0 + (docs - df.get(w, 0) + 0.5) / (df.get(w, 0) + 0.5)) for w in words]
        norm = lambda length: F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * length / F.lit(float(mean)))
        part = lambda i, tf, length: F.lit(idf[i]) * tf * F.lit(k1 + 1.0) / (tf + norm(length))
        if not words or k <= 0:
            return self.documents().limit(0).select("id", F.lit(0.0).alias("score"))

        def scored(blocks: DataFrame) -> DataFrame:
            tf = [F.coalesce(F.max(F.when(F.col("term") == w, F.col("tf"))), F.lit(0)).cast("double").alias(f"tf{i}") for i, w in enumerate(words)]
            per = self._live(blocks).groupBy("id").agg(F.first("length").alias("length"), *tf)
            score = reduce(lambda a, i: a + part(i, F.col(f"tf{i}"), F.col("length")), range(len(words)), F.lit(0.0))
            return per.select("id", score.alias("score")).orderBy(F.col("score").desc(), F.col("id")).limit(k)

        bound = reduce(lambda a, i: F.when(F.col("term") == words[i], part(i, F.col("top_tf").cast("double"), F.col("least_length"))).otherwise(a),
                       range(len(words)), F.lit(0.0))
        bounds = rows.select("slice", "term", bound.alias("bound")).groupBy("slice", "term").agg(F.max("bound").alias("bound"))
        bounds = bounds.groupBy("slice").agg(F.sum("bound").alias("bound"))
        first = [r["slice"] for r in bounds.orderBy(F.col("bound").desc()).limit(k).collect()]
        best = scored(rows.where(F.col("slice").isin(first))).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).first()
        if best["n"] == k:  # a lower bound of the k-th best score of all
            rows = self._in_slices(rows, bounds.where(F.col("bound") >= best["least"] * (1 - 1e-9)).select("slice"))
        return scored(rows).where(F.col("score") > min_score)

    def _in_slices(self, rows: DataFrame, slices: DataFrame) -> DataFrame:
        """Blocks of some slices: named in the scan's filter if they are few."""
        some = [r["slice"] for r in slices.limit(NAMED_SLICES + 1).collect()]
        if len(some) <= NAMED_SLICES:
            return rows.where(F.col("slice").isin(some))
        return rows.join(slices, "slice", "left_semi")

    def _all_of(self, words: Sequence[str]) -> DataFrame:
        """Blocks of slices in which every word occurs."""
        rows = self._rows(words)
        full = rows.select("slice", "term").distinct().groupBy("slice").agg(F.count(F.lit(1)).alias("n"))
        return rows.join(full.where(F.col("n") == len(words)).select("slice"), "slice", "left_semi")

    def match(self, text: str, operator: str = "or", minimum_should_match: int | None = None) -> DataFrame:
        """Ids of the documents that hold one (``or``), all (``and``) or at
        least so many of the text's distinct words."""
        words = list(dict.fromkeys(analyze(text)))
        if operator not in ("or", "and"):
            raise ValueError(f"unknown operator {operator!r}")
        need = minimum_should_match or (len(words) if operator == "and" else 1)
        if not words or need > len(words):
            return self.documents().limit(0).select("id")
        blocks = self._all_of(words) if need == len(words) else self._rows(words)
        return self._live(blocks).groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= need).select("id")

    def phrase(self, text: str) -> DataFrame:
        """Ids of the documents in which the words follow each other."""
        words = analyze(text)
        own = list(dict.fromkeys(words))
        if not words:
            return self.documents().limit(0).select("id")
        held = [F.max(F.when(F.col("term") == w, F.col("places"))).alias(f"p{i}") for i, w in enumerate(own)]
        per = self._live(self._all_of(own), places=True).groupBy("id").agg(*held)
        at = lambda j: F.col(f"p{own.index(words[j])}")
        follow = lambda p: reduce(lambda a, j: a & F.array_contains(at(j), p + j), range(1, len(words)), F.lit(True))
        return per.where(reduce(lambda a, i: a & F.col(f"p{i}").isNotNull(), range(len(own)), F.lit(True))).where(
            F.exists(at(0), follow)).select("id")

    def more_like_this(self, like: DataFrame, text_field: str, id_field: str, like_id, k: int = 10, max_query_terms: int | None = None,
                       min_doc_freq: int = 1, max_doc_freq_ratio: float = 1.0, min_term_freq: int = 1, minimum_should_match: int = 1) -> DataFrame:
        """:func:`docsift.operators.text.more_like_this`: of ``like`` only the
        document ``like_id`` is read, the rest comes from its terms'
        postings."""
        asked = (like.where(F.col(id_field) == F.lit(like_id)).select(F.explode(tokens(text_field)).alias("term"))
                 .groupBy("term").agg(F.count(F.lit(1)).alias("tf")).where(F.col("tf") >= min_term_freq))
        buckets = self._segments()[-1]["buckets"]
        asked = asked.withColumn("bucket", F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(buckets)).cast("int"))
        rows = self._postings().join(asked.select("term", "bucket"), ["bucket", "term"], "left_semi")
        docs = self.totals()[0]
        found = (self._frequencies(rows).join(asked, "term")
                 .where((F.col("df") >= min_doc_freq) & (F.col("df") <= F.lit(max_doc_freq_ratio * docs)))
                 .withColumn("w", F.col("tf") * F.log(F.lit(float(docs)) / F.col("df"))))
        if max_query_terms is not None:
            found = found.orderBy(F.col("w").desc(), F.col("term")).limit(max_query_terms)
        chosen = self._postings().join(found.select("term", "bucket"), ["bucket", "term"], "left_semi")
        shared = (self._live(chosen).where(F.col("id") != F.lit(like_id)).groupBy("id").agg(F.count(F.lit(1)).alias("shared_terms"))
                  .where(F.col("shared_terms") >= minimum_should_match))
        return shared.orderBy(F.col("shared_terms").desc(), F.col("id")).limit(k).withColumnRenamed("id", id_field)


@contextmanager
def _batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Arrow batches of so many bytes at most for the jobs inside."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _named(docs: DataFrame, id_field: str, text_field: str) -> DataFrame:
    return docs.select(F.col(f"`{id_field}`").alias("id"), F.col(f"`{text_field}`").cast(T.StringType()).alias("text"))
