"""N-gram Jaccard self-join by a blocked sparse matrix product.

Rows of the matrix are documents (distinct shingle sets, copies are counted),
columns are word n-grams. Documents link when ``100 * |A & B| >= percent *
|A | B|``. The join is exact:

1. *Size-derived bounds.* A partner of a set of ``n`` shingles shares at least
   ``ceil(percent * n / 100)`` of them. So in any common order of the shingles
   (here: by hash) two partners share at least ``m`` of their first
   ``n - that + m`` ones; ``m`` grows with the set (:func:`_demand`).
2. *Pruning.* These prefixes are counted over all documents. A document with
   fewer prefix shingles that occur elsewhere than it shares with a partner of
   any size (:func:`_demand_any`) has no partner and is done; common lines or
   word pairs alone never make a candidate.
3. *Blocks.* The others are put with their most frequent prefix shingle and a
   size class, large groups dealt out by hash. Two blocks of neighbouring
   size classes are multiplied if they share enough prefix shingles; of each,
   only the documents that share enough with the other block take part.
4. *Product.* A task holds two blocks: incidence over the shingles found
   twice, overlap counts of all pairs by matrix product, size bound. It
   returns one row for each linked document (its number of links and a
   representative of its part), never the pairs.
5. *Components* of the representatives' edges by repeated hooking to the
   smallest neighbour and contraction.

Sets and shingles are told apart by 64-bit hashes. Frequent shingles, large
groups of copies and of near copies are counted by partial sums, split by
adaptive skew joins, or dealt out over blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .common import bounded, free_name, lower_ascii, table_of

#: Shingles and documents of one block (on average).
BLOCK_SHINGLES = 600_000
BLOCK_DOCS = 2048
#: Rows of the product's plan (a document in a pair of blocks), or keys of
#: documents to drop, about 64 bytes each, that may be broadcast to the texts;
#: more are joined by a shuffle.
BROADCAST_ROWS = 500_000
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


# ------------------------------------------------------------ shingle sets

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _A
    h = (h ^ (h >> np.uint64(27))) * _B
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct ``width``-word shingles of each text
    (A-Z lower-cased). With fewer words the whole sequence is one shingle;
    without words or text the set is empty."""
    lower = lower_ascii(texts)
    trimmed = pc.ascii_trim(lower, characters=" \t\n\x0b\x0c\r")
    parts = pc.ascii_split_whitespace(trimmed)
    offsets = parts.offsets.to_numpy()
    offsets = offsets - offsets[0]
    coded = parts.values.dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False)
    word = pd.util.hash_array(names.astype(object), categorize=False) if len(names) else np.zeros(0, np.uint64)
    word = word[coded.indices.to_numpy()]
    blank = pc.binary_length(trimmed).to_numpy() == 0
    n = len(word)
    rolled = np.zeros(max(n - width + 1, 0), np.uint64)
    for i in range(width):
        rolled = _mix(rolled + word[i: n - width + 1 + i] + np.uint64(width))
    out = []
    for i in range(len(texts)):
        a, b = offsets[i], offsets[i + 1]
        if blank[i]:
            out.append(np.zeros(0, np.uint64))
        elif b - a < width:
            h = np.zeros(1, np.uint64)
            for w in word[a:b]:
                h = _mix(h + w + np.uint64(b - a))
            out.append(h)
        else:
            out.append(np.unique(rolled[a: b - width + 1]))
    return out


def _need(n, percent: int):
    """Fewest shingles that a partner of a set of ``n`` shares."""
    return -(-percent * n // 100)


def _demand(n, percent: int):
    """Prefix shingles that two partners of such size share at least."""
    return 1 + (n - _need(n, percent) + 1) // 2


def _need_column(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100).cast("long")


def _demand_column(n: Column, percent: int) -> Column:
    return (F.floor((n - _need_column(n, percent) + 1) / 2) + 1).cast("long")


def _demand_any(n: Column, percent: int) -> Column:
    """Prefix shingles that a set of ``n`` shares at least with a partner of
    any size. Two sets that share ``both`` shingles share as many prefix
    shingles as the shorter prefix allows, which may be the smaller set's;
    larger partners allow ``n``'s own demand."""
    def shared(size: Column, both: Column) -> Column:
        return _demand_column(size, percent) + both - _need_column(size, percent)

    def partner(size: Column) -> Column:
        both = F.ceil((n + size) * percent / (100 + percent)).cast("long")
        return F.least(both, shared(n, both), shared(size, both))

    smaller = F.array_min(F.transform(F.sequence(_need_column(n, percent), n), partner))
    return F.least(_demand_column(n, percent), smaller)


def _sets(docs: DataFrame, width: int, id_col: str, text_col: str, column: str, emit) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            sets = shingle_sets(batch.column("text"), width)
            size = [len(s) for s in sets]
            key = [_set_key(s) for s in sets]
            yield table_of(doc_id=batch.column("doc_id"), n=pa.array(size, pa.int64()), cls=pa.array(key, pa.int64()),
                           data=emit(sets))

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"doc_id long, n long, cls long, data {column}")


def _prefixes(percent: int):
    def emit(sets: list[np.ndarray]) -> pa.Array:
        cut = [s[: len(s) - _need(len(s), percent) + _demand(len(s), percent)] for s in sets]
        ends = np.cumsum([0, *map(len, cut)])
        flat = np.concatenate(cut) if cut else np.zeros(0, np.uint64)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))
    return emit


# ------------------------------------------------------------ the product

def link_block(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Which sets of the left block link with which of the right one (None:
    the left block itself, without its diagonal)."""
    rows = left if right is None else [*left, *right]
    size = np.asarray([len(s) for s in rows], np.int64)
    a = len(left)
    share = slice(0, a) if right is None else slice(a, None)
    width = len(rows[share])
    if len(rows) <= 6:
        overlap = np.zeros((a, width), np.float32)
        for i in range(a):
            for j in range(width):
                x, y = rows[i], rows[(0 if right is None else a) + j]
                if (right is not None or j > i) and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                    overlap[i, j] = len(np.intersect1d(x, y, assume_unique=True))
        if right is None:
            overlap = np.maximum(overlap, overlap.T)
    else:
        column, at = np.unique(np.concatenate(rows), return_inverse=True)
        owner = np.repeat(np.arange(len(rows)), size)
        twice = np.bincount(at) > 1
        if right is not None:  # only columns of both blocks count
            twice = np.zeros(len(column), bool)
            twice[at[owner < a]] = True
            other = np.zeros(len(column), bool)
            other[at[owner >= a]] = True
            twice &= other
        name = np.cumsum(twice) - 1
        keep = twice[at]
        owner, at = owner[keep], name[at[keep]]
        order = np.argsort(at, kind="stable")
        owner, at = owner[order], at[order]
        overlap = np.zeros((a, width), np.float32)  # whole numbers, exact below 2**24
        for lo in range(0, int(twice.sum()), 1024):
            i, j = np.searchsorted(at, (lo, lo + 1024))
            part = np.zeros((len(rows), 1024), np.float32)
            part[owner[i:j], at[i:j] - lo] = 1
            overlap += part[:a] @ part[share].T
    linked = np.zeros((a, width), bool)
    for lo in range(0, a, 256):
        some = overlap[lo: lo + 256].astype(np.int64)
        both = size[lo: lo + 256][: len(some), None] + size[share][None, :]
        linked[lo: lo + 256] = ((100 + percent) * some >= percent * both) & (some > 0)
    if right is None:
        np.fill_diagonal(linked, False)
    return linked


def _parts(linked: np.ndarray) -> np.ndarray:
    """Smallest row number of each row's part in a symmetric link matrix."""
    label = np.arange(len(linked))
    if not len(label):
        return label
    while True:
        # columns by label: the first link of a row leads to its lowest label
        order = np.argsort(label, kind="stable")
        first = linked[:, order].argmax(1)
        has = linked[np.arange(len(label)), order[first]]
        new = np.where(has, np.minimum(label, label[order[first]]), label)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _unit(key: np.ndarray, block: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], cross: bool,
          percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked documents of a unit, their links and representatives."""
    key, first = np.unique(key, return_index=True)  # repeated rows of a document
    block, copies, sets = block[first], copies[first], [sets[i] for i in first]
    if cross:
        a, b = np.flatnonzero(block == block.min()), np.flatnonzero(block != block.min())
        if not len(a) or not len(b):
            return (np.zeros(0, np.int64),) * 3
        linked = np.zeros((len(key), len(key)), bool)
        linked[np.ix_(a, b)] = link_block([sets[i] for i in a], [sets[i] for i in b], percent)
        linked |= linked.T
    else:
        linked = link_block(sets, None, percent)
    links = np.concatenate([linked[lo: lo + 256] @ copies for lo in range(0, len(key), 256)] or [copies[:0]])
    some = np.flatnonzero(links)
    return key[some], links[some], key[_parts(linked)[some]]


def _product(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None

        def done() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            sets = [np.frombuffer(x, np.uint64) for x in rows["data"].to_pylist()]
            out = _unit(rows["cls"].to_numpy(), rows["block"].to_numpy(), rows["copies"].to_numpy(), sets,
                        now[0] != now[1], percent)
            return table_of(cls=pa.array(out[0], pa.int64()), links=pa.array(out[1], pa.int64()),
                            root=pa.array(out[2], pa.int64()))

        for batch in batches:  # sorted by unit
            if not batch.num_rows:
                continue
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(a) != 0) | (np.diff(b) != 0)) + 1).tolist(), len(a)]
            for lo, hi in zip(cuts, cuts[1:]):
                unit = a[lo], b[lo]
                if now is not None and unit != now:
                    yield done()
                    held = []
                now = unit
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield done()
    return run


# ------------------------------------------------------------ components

def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of ``a, b`` edges: one root for each
    connected part. Every round hooks each node to its smallest neighbour,
    follows the hooks to their ends, and contracts the edges; node numbers
    are hashes, so hooks are short and a round removes a good part of the
    nodes. Each table is checkpointed and shrinks from round to round."""
    both = lambda e: e.select("a", "b").union(e.select("b", "a"))
    edges = cut_lineage(edges.where("a <> b").distinct())
    found = cut_lineage(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
                        .withColumn("root", F.col("node")))
    while not edges.isEmpty():
        hook = both(edges).groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("up"))
        hook = cut_lineage(hook)
        while True:
            above = hook.select(F.col("a").alias("up"), F.col("up").alias("top"))
            longer = cut_lineage(hook.join(above, "up").select("a", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")))
            hook = longer.select("a", "up")
            if not longer.agg(F.coalesce(F.max("moved"), F.lit(False))).first()[0]:
                break
        new = hook.select(F.col("a").alias("root"), "up")
        found = cut_lineage(found.join(new, "root", "left").select("node", F.coalesce("up", "root").alias("root")))
        ends = edges.join(hook.select("a", F.col("up").alias("x")), "a").join(
            hook.select(F.col("a").alias("b"), F.col("up").alias("y")), "b")
        edges = cut_lineage(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return found


# ------------------------------------------------------------ the join

def _pruned(rows: DataFrame, percent: int) -> DataFrame:
    """From ``cls, n, tokens``: the documents with enough tokens that occur
    elsewhere, with those tokens and how often each occurs."""
    posted = rows.select("cls", "n", F.explode("tokens").alias("token"))
    often = posted.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = posted.join(often, "token").groupBy("cls").agg(
        F.first("n").alias("n"), F.collect_list(F.struct("df", "token")).alias("shared"))
    return cut_lineage(shared.where(F.size("shared") >= _demand_any(F.col("n"), percent)))


def jaccard_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links, class_id, set_key,
    component_key`` for every row.

    ``class_id``: smallest id with the same shingle set (``set_key``).
    ``component_key``: a key shared by the rows of a component. ``n_links``: rows
    (other than this one) that the document links with, copies included.
    ``component_id``: smallest id reachable by links. A row without shingles
    (NULL, empty or blank text) links with nothing: both are its own id. NULL
    ids take part; they are never a class's smallest id unless it has no
    other. Repeated rows are copies of each other."""
    none = lambda sets: pa.nulls(len(sets), pa.binary())
    rows = cut_lineage(_sets(docs, width, id_col, text_col, "binary", none).drop("data"))
    counted = rows.where("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("copies"))
    sets = (_sets(docs, width, id_col, text_col, "array<long>", _prefixes(percent)).where("n > 0")
            .groupBy("cls").agg(F.first("n").alias("n"), F.first("data").alias("tokens")))
    once = _pruned(sets, percent)
    alive = _pruned(once.select("cls", "n", F.expr("transform(shared, x -> x.token)").alias("tokens")), percent)

    # blocks: most frequent shared shingle and size class, large groups dealt out
    step = math.log(100 / percent) * 1.0001 if percent < 100 else 1.0  # partners lie one class apart at most
    top = F.array_max("shared")["token"]
    keyed = alive.select("cls", "n", top.alias("top"), F.floor(F.log("n") / step).alias("size"),
                         F.expr("transform(shared, x -> x.token)").alias("tokens"))
    groups = keyed.groupBy("top", "size").agg(F.greatest(
        F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_DOCS)).cast("long").alias("of"))
    deal = F.pmod(F.xxhash64("cls"), F.col("of"))
    placed = cut_lineage(keyed.join(groups, ["top", "size"]).select(
        "cls", "n", "size", F.xxhash64("top", "size", deal).alias("block"), "tokens"))

    held = placed.select("block", "size", F.explode("tokens").alias("token")).distinct()
    left = held.select("token", F.col("block").alias("a"), F.col("size").alias("size_a"))
    right = held.select("token", F.col("block").alias("b"), F.col("size").alias("size_b"))
    near = (F.col("a") < F.col("b")) & (F.abs(F.col("size_a") - F.col("size_b")) <= 1)
    met = cut_lineage(left.join(right, "token").where(near).select("token", "a", "b", "size_a", "size_b"))
    least = lambda size: _demand_column(F.greatest(F.lit(1), F.floor(F.exp(size * step)) - 1), percent)
    pairs = met.groupBy("a", "b", "size_a", "size_b").agg(F.count(F.lit(1)).alias("shared")).where(
        F.col("shared") >= least(F.least("size_a", "size_b"))).select("a", "b")
    met = met.join(pairs, ["a", "b"])
    side = lambda own, other: met.select(
        "token", F.col(own).alias("block"), F.col(other).alias("other"), F.col(f"size_{other}").alias("size_other"))
    # of each block, only documents that share enough with the other block
    some = (placed.select("cls", "n", "block", F.explode("tokens").alias("token"))
            .join(side("a", "b").union(side("b", "a")), ["block", "token"])
            .groupBy("cls", "n", "block", "other", "size_other").agg(F.count(F.lit(1)).alias("shared"))
            .where(F.col("shared") >= F.least(_demand_column(F.col("n"), percent), least(F.col("size_other"))))
            .select("cls", "block", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b")))
    large = placed.groupBy("block").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1").select("block")
    own = placed.join(large, "block").select("cls", "block", F.col("block").alias("a"), F.col("block").alias("b"))
    work = cut_lineage(some.union(own).join(counted, "cls").select("cls", "block", "a", "b", "copies", "class_id"))

    # whole sets of those documents, once for each product
    wanted = F.broadcast(work) if work.count() <= BROADCAST_ROWS else work
    whole = _sets(docs, width, id_col, text_col, "binary", lambda sets: pa.array([s.tobytes() for s in sets], pa.binary()))
    whole = whole.withColumnRenamed("doc_id", "own")
    work = (whole.join(wanted, "cls").where(F.col("own").eqNullSafe(F.col("class_id")))
            .select("cls", "block", "copies", "data", "a", "b")
            .repartition("a", "b").sortWithinPartitions("a", "b", "cls"))
    linked = cut_lineage(work.mapInArrow(_product(percent), "cls long, links long, root long"))

    links = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    parts = components(linked.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    joined = counted.join(parts.withColumnRenamed("node", "cls"), "cls", "left").join(links, "cls", "left")
    joined = joined.withColumn("root", F.coalesce("root", "cls"))
    lowest = joined.groupBy("root").agg(F.min("class_id").alias("component"))
    classes = joined.join(lowest, "root").select(
        "cls", "class_id", "component", "root", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    out = rows.select("doc_id", "n", _row_key().alias("cls"))
    out = out.join(classes, "cls", "left")
    empty = F.col("n") == 0
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(empty, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
                      F.when(empty, 0).otherwise(F.col("links")).alias("n_links"),
                      F.when(empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.col("cls").alias("set_key"), F.coalesce("root", "cls").alias("component_key"))


def _row_key() -> Column:
    """The set's hash; rows without shingles have a key of their id."""
    return F.coalesce("cls", F.xxhash64("doc_id"))


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component
    does: the one with the smallest id (NULL last). Repeated rows stay once,
    rows without shingles all stay (repeated ones once). All columns are kept,
    whatever their names.

    Rows are told to go by their set and id. Up to :data:`BROADCAST_ROWS` such
    keys are broadcast, so no text is shuffled; more are joined by a shuffle
    on set and id, so a large group of copies does not meet in one task."""
    mark = free_name(docs.columns, "set_key")
    gone_id, gone_key = (free_name([*docs.columns, mark], c) for c in ("gone_id", "gone_key"))
    marks = jaccard_classes(docs, id_col=id_col, text_col=text_col, width=width, percent=percent)
    marks = cut_lineage(marks.groupBy("component_key", "doc_id", "set_key").agg(F.count(F.lit(1)).alias("rows")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "set_key")).alias("first")
    stays = marks.groupBy("component_key").agg(first).select("component_key", "first")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("set_key") == F.col("first.set_key"))
    marks = cut_lineage(marks.join(stays, "component_key").select("doc_id", "set_key", "rows", same.alias("stays")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, text_col):
            key = [_set_key(s) for s in shingle_sets(batch.column(text_col), width)]
            yield pa.record_batch([*batch.columns, pa.array(key, pa.int64())], [*batch.schema.names, mark])

    rows = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(mark, T.LongType())]))
    own = F.col(f"`{id_col}`").cast("long")
    rows = rows.withColumn(mark, F.coalesce(F.col(f"`{mark}`"), F.xxhash64(own)))
    at = (F.col(f"`{mark}`") == F.col(f"`{gone_key}`")) & own.eqNullSafe(F.col(f"`{gone_id}`"))
    keys = lambda which: marks.where(which).select(
        F.col("doc_id").alias(gone_id), F.col("set_key").alias(gone_key))
    gone, repeated = "not stays or rows > 1", "stays and rows > 1"
    n = marks.agg(F.count_if(F.expr(gone)).alias("gone"), F.count_if(F.expr(repeated)).alias("repeated")).first()
    hint = F.broadcast if n["gone"] <= BROADCAST_ROWS else lambda x: x
    out = rows.join(hint(keys(gone)), at, "left_anti")
    if n["repeated"]:  # their rows are read apart, and once each
        out = out.union(rows.join(hint(keys(repeated)), at, "left_semi").dropDuplicates([id_col, mark]))
    return out.drop(mark)


def _set_key(shingles: np.ndarray) -> int | None:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63) if len(shingles) else None
