"""A Merkle manifest of a dataset by time-forward processing.

Leaves are hashes of rows. Each tree (a source) hashes every ``FAN``
consecutive nodes to one until one is left, its subroot; the subroots, in the
order of their names, are the leaves of one more tree, whose top is the root.

* *Forward sweep.* Nodes are processed in the order of their labels (end of
  the leaves they cover, level), so children come before their parent. A
  node's digest is a message to its parent's label; a priority queue ordered
  by label delivers it when the sweep gets there (:func:`sweep_up`). Inside a
  block of ``FAN ** DEPTH`` leaves the queue is a heap in which at most
  ``FAN`` messages a level wait. Between blocks it is external: Spark's sorted
  shuffle, which spills to disk, brings the digests of blocks to the block of
  their parents in the next round, so there are as many rounds as the logarithm
  of the longest tree to that base.
* *Reversed sweep.* In falling order of labels each node hands its children
  the suffix of their proofs: the siblings at every level above
  (:func:`sweep_down`). One message a block goes through the shuffle, never
  one a leaf.

A block is the unit of work: a tree that holds a third of all rows is many
blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import positions
from ..session import cut_lineage
from .common import table_of, work_path

#: Children of a node; levels that one block covers.
FAN, DEPTH = 16, 3
BLOCK = FAN ** DEPTH
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*values: Column) -> Column:
    """Lower-case hex SHA-256 of the values, each ``-`` if NULL, else its
    UTF-8 byte count, a colon and itself."""
    def part(v: Column) -> Column:
        v = v.cast("string")
        return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return F.sha2(F.concat(*map(part, values)), 256)


def leaves(docs: DataFrame, fields: Sequence[str], *, id_col: str = "doc_id", tree_col: str = "source",
           changed: Mapping[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """``tree, id, digest, other`` for every row: the digest of its
    ``fields``, and for rows that hold ``where`` the one with some fields
    ``changed`` (else NULL)."""
    column = lambda c: F.col(f"`{c}`")
    now = [(changed or {}).get(c, column(c)) for c in fields]
    other = F.when(where, digest(*now)) if where is not None else F.lit(None).cast("string")
    return docs.select(column(tree_col).cast("string").alias("tree"), column(id_col).cast("long").alias("id"),
                       digest(*map(column, fields)).alias("digest"), other.alias("other"))


# ------------------------------------------------------------ sweeps of one block

def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes."""
    levels = 0
    while FAN ** levels < n:
        levels += 1
    return levels


def sweep_up(block: Iterator[str], levels: int) -> list[list[str]]:
    """Digests by level of the tree above a block's nodes (level 0)."""
    found: list[list[str]] = [[] for _ in range(levels + 1)]
    queue: list[tuple[int, int, int, str]] = []  # label (end, level), child's place, child's digest

    def deliver(end: int, level: int, digest: str) -> None:
        """A node is done: its digest goes forward to its parent."""
        place = len(found[level])
        found[level].append(digest)
        if level < levels:
            width = FAN ** (level + 1)
            heapq.heappush(queue, (-(-end // width) * width, level + 1, place, digest))

    def process() -> None:
        end, level = queue[0][:2]
        children = []
        while queue and queue[0][:2] == (end, level):
            children.append(heapq.heappop(queue)[3])
        deliver(end, level, _hash("".join(children)))

    for i, leaf in enumerate(block):
        while queue and queue[0][:2] < (i + 1, 0):
            process()
        deliver(i + 1, 0, leaf)
    while queue:
        process()
    return found


def sweep_down(found: list[list[str]], suffix: tuple) -> Iterator[tuple[int, tuple]]:
    """Place and path of a block's nodes, the last one first: (left, right)
    siblings at every level from the node up, ending with ``suffix``, the path
    of the block's top."""
    levels = len(found) - 1
    queue = [((-(FAN ** levels), -levels), 0, suffix)]
    while queue:
        (_, level), place, path = heapq.heappop(queue)
        if not level:
            yield place, path
            continue
        below = -level - 1
        lo = place * FAN
        children = found[below][lo: lo + FAN]
        width = FAN ** below
        for i in range(len(children)):
            siblings = "".join(children[:i]), "".join(children[i + 1:])
            heapq.heappush(queue, ((-(lo + i + 1) * width, -below), lo + i, (siblings, path)))


def _steps(path: tuple) -> Iterator[tuple[str, str]]:
    while path:
        step, path = path
        yield step


def _text(path: tuple) -> str:
    return "/".join("|".join(step) for step in _steps(path))


def _path(text: str) -> tuple:
    out: tuple = ()
    for step in reversed(text.split("/") if text else []):
        out = (tuple(step.split("|")), out)
    return out


def fold(leaf: str, path: tuple) -> str:
    """The root that a leaf and the siblings of its path lead to."""
    for left, right in _steps(path):
        leaf = _hash(left + leaf + right)
    return leaf


# ------------------------------------------------------------ rounds

_NODE = "tree string, block long, at int, n long, digest string, id long, name string, other string"


def _placed(nodes: DataFrame, place: str) -> DataFrame:
    """Nodes of a round (``tree, place, n, digest``) with their block."""
    have = set(nodes.columns)
    extra = {"id": "long", "name": "string", "other": "string"}
    return nodes.select("tree", F.floor(F.col(place) / BLOCK).cast("long").alias("block"), (F.col(place) % BLOCK).cast("int").alias("at"),
                        "n", "digest", *[F.col(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in extra.items()])


def _blocks(batches: Iterator[pa.RecordBatch], first: int) -> Iterator[list[dict]]:
    """Rows of one block after the other; each begins with place ``first``."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if row["at"] == first and held:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _levels(rows: list[dict]) -> int:
    return DEPTH if rows[0]["n"] > BLOCK else height(rows[0]["n"])


def _run_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _blocks(batches, 0):
        top = sweep_up((r["digest"] for r in rows), _levels(rows))[-1][0]
        yield table_of(tree=pa.array([rows[0]["tree"]], pa.string()), place=pa.array([rows[0]["block"]], pa.int64()),
                       n=pa.array([-(-rows[0]["n"] // BLOCK)], pa.int64()), digest=pa.array([top], pa.string()))


def _climb(bottom: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """All rounds of the forward sweep above ``bottom`` (rows of blocks), and
    the trees' tops: ``tree, digest, round``."""
    rounds, tops = [bottom], None
    while True:
        by_block = rounds[-1].repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
        above = cut_lineage(by_block.mapInArrow(_run_up, "tree string, place long, n long, digest string"))
        done = above.where("n = 1").select("tree", "digest", F.lit(len(rounds) - 1).alias("round"))
        tops = done if tops is None else tops.union(done)
        rest = above.where("n > 1")
        if rest.isEmpty():
            return rounds, tops
        rounds.append(_placed(rest, "place"))


def _run_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages to the nodes of blocks that each begin with a message."""
    for rows in _blocks(batches, -1):
        told, rows = rows[0], rows[1:]
        found = sweep_up((r["digest"] for r in rows), _levels(rows))
        out = [(rows[i], told["block"] * BLOCK + i, _text(path)) for i, path in sweep_down(found, _path(told["digest"]))]
        yield table_of(tree=pa.array([r["tree"] for r, _, _ in out], pa.string()), block=pa.array([b for _, b, _ in out], pa.int64()),
                       suffix=pa.array([s for _, _, s in out], pa.string()), name=pa.array([r["name"] for r, _, _ in out], pa.string()),
                       top=pa.array([told["other"] or r["digest"] for r, _, _ in out], pa.string()))


def _run_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _blocks(batches, -1):
        told, rows = rows[0], rows[1:]
        found = sweep_up((r["digest"] for r in rows), _levels(rows))
        out = []
        for i, path in sweep_down(found, _path(told["digest"])):
            r = rows[i]
            proof = _hash("".join(left + right for left, right in _steps(path)))
            out.append((r["id"], r["tree"], r["digest"], proof, fold(r["other"] or r["digest"], path)))
        columns = list(zip(*out))
        yield table_of(id=pa.array(columns[0], pa.int64()), tree=pa.array(columns[1], pa.string()),
                       leaf=pa.array(columns[2], pa.string()), subroot=pa.array([told["other"]] * len(out), pa.string()),
                       proof_sha256=pa.array(columns[3], pa.string()), folded_root=pa.array(columns[4], pa.string()))


def _told(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    """Blocks of nodes, each led by its message (``tree, block, suffix,
    top``): place -1, the suffix as digest, the tree's top beside it."""
    none = lambda kind: F.lit(None).cast(kind)
    heads = messages.select("tree", "block", F.lit(-1).alias("at"), none("long").alias("n"), F.col("suffix").alias("digest"),
                            none("long").alias("id"), none("string").alias("name"), F.col("top").alias("other"))
    return nodes.union(heads).repartition("tree", "block").sortWithinPartitions("tree", "block", "at")


def _descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The reversed sweep down to the bottom's blocks: their messages. ``tops``:
    ``tree, round, suffix, top``."""
    starts = lambda r: tops.where(F.col("round") == r).select("tree", F.lit(0).cast("long").alias("block"), "suffix", "top")
    told = starts(len(rounds) - 1)
    for r in range(len(rounds) - 1, 0, -1):
        sent = _told(rounds[r], told).mapInArrow(_run_down, "tree string, block long, suffix string, name string, top string")
        told = cut_lineage(sent.select("tree", "block", "suffix", "top").union(starts(r - 1)))
    return told


def proofs(rows: DataFrame) -> DataFrame:
    """``id, tree, leaf, subroot, root, proof_sha256, folded_root`` for every
    leaf (``tree, id, digest, other``). ``proof_sha256`` is the hash of all
    siblings from the leaf's run to the root's; ``folded_root`` is what
    ``other`` (where NULL: the leaf) and these siblings lead to.

    Leaves of a tree ascend by id, NULL first, rows of one id by digest (so
    repeated rows are leaves of their own with equal digests); trees ascend by
    name, NULL first. A lone leaf is its tree's subroot, a lone subroot the
    root (no siblings: the proof is the hash of nothing). No rows give no
    rows. The leaves are written once to the shared work folder."""
    spark = rows.sparkSession
    path = work_path(spark, "merkle-leaves")
    order = [F.col("id").asc_nulls_first(), F.col("digest")]
    placed = positions(rows, ["tree"], order, position="place", totals=True).withColumnRenamed("_n", "n")
    _placed(placed, "place").write.parquet(path)
    bottom = spark.read.parquet(path)
    rounds, tops = _climb(bottom)

    names = positions(tops.withColumnRenamed("tree", "name"), [], [F.col("name").asc_nulls_first()], position="place")
    trees = tops.count()  # a number, not the trees
    upper = cut_lineage(_placed(names.select(F.lit("").alias("tree"), "place", F.lit(trees).cast("long").alias("n"), "digest", "name"), "place"))
    upper_rounds, peak = _climb(upper)
    root = peak.select("digest").first()
    root = root["digest"] if root else ""

    told = _descend(upper_rounds, peak.select("tree", "round", F.lit("").alias("suffix"), F.lit(None).cast("string").alias("top")))
    heard = _told(upper, told).mapInArrow(_run_down, "tree string, block long, suffix string, name string, top string")
    heard = heard.select(F.col("name").alias("of"), "suffix", "top")
    heads = tops.select("tree", "round").join(heard, F.col("tree").eqNullSafe(F.col("of"))).select("tree", "round", "suffix", "top")
    told = _descend(rounds, cut_lineage(heads))
    out = _told(bottom, told).mapInArrow(
        _run_leaves, "id long, tree string, leaf string, subroot string, proof_sha256 string, folded_root string")
    return out.withColumn("root", F.lit(root))


def manifest(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), *, id_col: str = "doc_id",
             tree_col: str = "source", changed: Mapping[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """The manifest of a table: :func:`proofs` of its :func:`leaves`, with
    ``verified``: whether the leaf, changed where asked, still leads to the
    root. NULL fields have a hash of their own; other columns are not read."""
    out = proofs(leaves(docs, fields, id_col=id_col, tree_col=tree_col, changed=changed, where=where))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
