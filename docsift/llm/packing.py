"""Best-fit packing of token pieces into sequences by a grouping genetic
algorithm on islands.

* :func:`pieces` encodes whole texts and cuts only documents longer than the
  capacity.
* :func:`pack` deals the pieces out to independent problems of about
  ``problem_rows`` pieces (by row number, so a hot document id is spread) and
  solves each problem on ``islands`` islands. A chromosome is a grouping of
  pieces into bins. Crossover injects whole well-filled bins of one parent
  into the other, removes bins that hold duplicates of the injected pieces,
  and best-fits the displaced pieces, longest first. After every epoch each
  island's elite migrates to the next island of the ring (one small row per
  island is shuffled). A problem whose best grouping reaches the lower bound
  ``ceil(sum / capacity)`` is optimal and is not evolved further.

The first chromosome of an island is best-fit decreasing, so the result is
never worse than that.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import bounded, free_name
from .tokens import Encoder


def pieces(docs: DataFrame, *, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text",
           tokenizer: str | None = None, end_id: int | None = 1) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every whole text's ids
    (NULL: empty), with ``end_id`` appended, cut into pieces of ``capacity``
    ids where longer (the last may be shorter). Repeated rows give repeated
    pieces; a text without ids (no end id) gives none."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder.of(tokenizer)
        tail = np.asarray([] if end_id is None else [end_id], "<u4")
        for batch in bounded(batches, "text"):
            flat, off = enc.encode(batch.column("text"))
            flat, out = flat.astype("<u4"), []
            for i, name in enumerate(batch.column("doc_id").to_pylist()):
                own = np.concatenate([flat[off[i]: off[i + 1]], tail])
                for k, lo in enumerate(range(0, len(own), capacity)):
                    part = own[lo: lo + capacity]
                    out.append((name, k, lo, len(part), zlib.crc32(part.tobytes())))
            cols = list(zip(*out)) if out else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)],
                                  ["doc_id", "piece", "start", "length", "ids_crc32"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


# ------------------------------------------------------------ one problem

def best_fit(lengths: Sequence[int], items: Sequence[int], capacity: int,
             room: Sequence[int] = ()) -> tuple[list[int], int]:
    """Put ``items`` (indexes, longest first) into the fullest bin that still
    has room; bins ``0 .. len(room)-1`` have ``room`` left. Returns each
    item's bin and the number of bins. ``open_at`` is a bit set of the free
    spaces on offer, so the tightest fit is its lowest bit at or above the
    length."""
    bins: dict[int, list[int]] = {}
    open_at = 0
    for b, r in enumerate(room):
        if r:
            bins.setdefault(r, []).append(b)
            open_at |= 1 << r
    n, out = len(room), []
    for i in items:
        size = lengths[i]
        above = open_at >> size
        if above:
            r = size + ((above & -above).bit_length() - 1)
            b = bins[r].pop()
            if not bins[r]:
                open_at ^= 1 << r
            r -= size
        else:
            b, r = n, capacity - size
            n += 1
        if r:
            bins.setdefault(r, []).append(b)
            open_at |= 1 << r
        out.append(b)
    return out, n


def fitness(bin_of: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Number of bins (fewer is better), then the mean squared fill (negated)."""
    fill = np.bincount(bin_of, lengths)
    return len(fill), -float(np.mean((fill / capacity) ** 2))


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int,
              rng: np.random.Generator) -> np.ndarray:
    """Child of ``a`` with some well-filled bins of ``b``; pieces are indexed
    longest first. Also dissolves a few of ``a``'s emptiest bins."""
    fill_b = np.bincount(b, lengths)
    good = np.flatnonzero(fill_b >= np.quantile(fill_b, 0.5))
    inject = rng.choice(good, max(1, int(len(good) * rng.uniform(0.1, 0.5))), replace=False)
    into = np.full(len(fill_b), -1)
    into[inject] = np.arange(len(inject))
    child = into[b]  # the injected bins
    taken = child >= 0
    fill_a = np.bincount(a, lengths)
    broken = np.zeros(len(fill_a), bool)
    broken[a[taken]] = True  # bins that hold duplicates
    weak = np.argsort(fill_a)[: 1 + int(len(fill_a) * 0.02)]
    broken[weak] = True
    kept = np.flatnonzero(~broken)
    rename = np.full(len(fill_a), -1)
    rename[kept] = len(inject) + np.arange(len(kept))
    child = np.where(taken, child, rename[a])
    displaced = np.flatnonzero(child < 0)
    n = len(inject) + len(kept)
    room = capacity - np.bincount(child[child >= 0], lengths[child >= 0], minlength=n).astype(int)
    placed, _ = best_fit(lengths.tolist(), displaced.tolist(), capacity, room.tolist())
    child[displaced] = placed
    return child


def evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, generations: int,
           size: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Run one epoch on an island; returns the population, best first. An
    empty population starts from best-fit decreasing and best-fit of slightly
    shuffled orders."""
    bound = -(-int(lengths.sum()) // capacity)
    plain, order = lengths.tolist(), np.arange(len(lengths))
    scored = [(fitness(p, lengths, capacity), p) for p in population]
    while len(scored) < size and (not scored or min(s[0][0] for s in scored) > bound):
        keys = order if not scored else np.argsort(order + rng.normal(0, 0.02 * len(order), len(order)))
        placed, _ = best_fit(plain, keys.tolist(), capacity)
        start = np.empty(len(lengths), np.int64)
        start[keys] = placed
        scored.append((fitness(start, lengths, capacity), start))
    scored.sort(key=lambda s: s[0])
    for _ in range(generations):
        if scored[0][0][0] <= bound or len(scored) < 2:
            break
        i, j = rng.choice(len(scored), 2, replace=False)
        for x, y in ((i, j), (j, i)):
            child = crossover(scored[x][1], scored[y][1], lengths, capacity, rng)
            scored.append((fitness(child, lengths, capacity), child))
        scored = sorted(scored, key=lambda s: s[0])[:size]
    return [p for _, p in scored]


# ------------------------------------------------------------ all problems

def pack(rows: DataFrame, *, capacity: int = 4096, length_col: str = "length", problem_rows: int = 8192,
         islands: int = 3, epochs: int = 2, generations: int = 8, population: int = 6, seed: int = 7) -> DataFrame:
    """``rows`` plus ``sequence_id`` and ``offset``: a place for every row in
    sequences of at most ``capacity``, gapless from 0. Lengths must lie in
    1..capacity; NULL, zero or longer lengths raise. Other columns are
    carried along; where they have one of the two names, the new one gets
    underscores. An empty table gives an empty table.

    A problem holds ``problem_rows`` rows on average, whatever the table's
    size or keys, so no task holds more."""
    sequence_id, offset = (free_name(rows.columns, c) for c in ("sequence_id", "offset"))
    spark = rows.sparkSession
    carried = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    size = F.col(f"`{length_col}`")
    checked = F.when(size.between(1, capacity), size.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("length out of range: "), F.coalesce(size.cast("string"), F.lit("NULL")))).cast("int"))
    # the row number is fixed by the checkpoint: later reads agree after a lost executor
    items = cut_lineage(rows.select(checked.alias("length"), carried.alias("row")))
    count = items.count()
    n_problems = max(1, -(-count // problem_rows))
    items = items.select("*", F.monotonically_increasing_id().alias("no")).withColumn(
        "problem", F.pmod(F.xxhash64("no", F.lit(seed)), F.lit(n_problems)).cast("int"))
    parts = min(n_problems, 4 * spark.sparkContext.defaultParallelism)

    def state(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = np.sort(pdf["length"].to_numpy())[::-1].astype(np.int32)
        return pd.DataFrame({"problem": pdf["problem"].iloc[:1].to_numpy(), "lengths": [lengths.tobytes()]})

    def epoch(number: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for r in pdf.itertuples(index=False):
                    lengths = np.frombuffer(r.lengths, np.int32).astype(np.int64)
                    came = [np.frombuffer(x, np.int32).astype(np.int64) for x in (r.own, r.guest) if x]
                    rng = np.random.default_rng([seed, r.problem, r.island, number])
                    best = evolve(lengths, came, capacity, generations, population, rng)[0]
                    yield pd.DataFrame({"problem": [r.problem], "island": [r.island], "lengths": [r.lengths],
                                        "bins": [int(best.max()) + 1], "elite": [best.astype(np.int32).tobytes()]})
        return run

    kind = "problem int, island int, lengths binary, bins int, elite binary"
    problems = items.select("problem", "length").groupBy("problem").applyInPandas(state, "problem int, lengths binary")
    none = F.lit(None).cast("binary")
    start = problems.select("problem", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "lengths",
                            none.alias("own"), none.alias("guest"))
    world = cut_lineage(start.repartition(parts * islands, "problem", "island").mapInPandas(epoch(0), kind))
    for e in range(1, epochs):
        guests = world.select("problem", ((F.col("island") + 1) % islands).alias("island"), F.col("elite").alias("guest"))
        moved = world.select("problem", "island", "lengths", F.col("elite").alias("own")).join(guests, ["problem", "island"])
        world = cut_lineage(moved.mapInPandas(epoch(e), kind))
    best = world.groupBy("problem").agg(F.min_by(F.struct("bins", "elite"), F.struct("bins", "island")).alias("b"))
    best = best.select("problem", "b.elite")

    def place(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(-left["length"].to_numpy(), kind="stable")
        left = left.iloc[order].reset_index(drop=True)
        bins = np.frombuffer(right["elite"].iloc[0], np.int32).astype(np.int64)
        by_bin = np.argsort(bins, kind="stable")
        sizes = left["length"].to_numpy()[by_bin].astype(np.int64)
        total = np.cumsum(sizes) - sizes
        first = np.r_[True, np.diff(bins[by_bin]) > 0]
        offset = np.empty(len(bins), np.int64)
        offset[by_bin] = total - np.maximum.accumulate(np.where(first, total, 0))
        return pd.DataFrame({"no": left["no"], "sequence_id": left["problem"].astype("int64") * (1 << 32) + bins,
                             "offset": offset})

    narrow = items.select("problem", "length", "no")
    placed = narrow.groupBy("problem").cogroup(best.groupBy("problem")).applyInPandas(
        place, "no long, sequence_id long, offset long")
    return items.join(placed, "no").select(
        *[F.col("row")[c].alias(c) for c in rows.columns], F.col("sequence_id").alias(sequence_id),
        F.col("offset").alias(offset))
