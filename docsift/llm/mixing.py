"""Mixing sources to target weights by Pareto order sampling, in DataFrame
functions only.

1. :func:`targets`: every source gets a share of the total by weight, at most
   ``cap`` times its own size; what is over goes to the others by weight.
2. :func:`inclusions`: within a source a document's expected copies are
   proportional to its class weight, at most ``cap``, so that expected sizes
   add up to the target. Classes are few (bit length of the size), so this is
   solved on a table of classes per source.
3. :func:`sample`: each document has its certain whole copies; for the rest
   of the target, documents are ranked by ``odds(u) / odds(p)`` (``u`` a
   random number made of the id, ``p`` the fractional part of the expected
   copies) and the lowest ranks are taken up to the rest's size. The fixed
   size is counted in words, so a source misses its target by half a document
   at most. Running sums cross range slices of ``(source, rank)``: a source
   that holds a third of all rows is summed by many tasks.

Documents then get their copies row by row from one cut per source; texts
are never shuffled. Rows with the same source, id and size draw the same
number and are taken together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import positions
from .common import free_name

#: Weights of the sources in order, repeating.
SOURCE_WEIGHTS = (3, 1, 2)
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(id_col: Column, seed: str) -> Column:
    """A number in (0, 1) made of the id (NULL: of the empty text)."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def size_class(size: Column) -> Column:
    """Weight of a document: the bit length of its size (a longer document is
    likelier, but less than in proportion)."""
    return F.length(F.bin(size)).cast("long")


def targets(sizes: DataFrame, *, share: float = 1.5, cap: int = 2, weights: tuple[int, ...] = SOURCE_WEIGHTS) -> DataFrame:
    """From ``source, size`` rows: ``source, source_size, target``. Sources
    (by code point, NULL last) weigh ``weights`` in turn, and the targets add
    up to ``share`` (below ``cap``) of all sizes, whatever sources tie. Places
    and running sums of the table of sources cross range slices, so it may
    have any length; its totals and the water level are one row."""
    by_name = F.col("source").asc_nulls_last()
    per = positions(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), [], [by_name], position="turn")
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                           (F.col("turn") % len(weights) + 1).cast("int")))
    top = cap * F.col("source_size")
    per = per.withColumn("level", top / F.col("w"))
    per = positions(per, [], [F.col("level"), by_name], sums={"tops": top, "ws": F.col("w")}, position=None)
    total = per.agg(F.sum("source_size").alias("words"), F.sum("w").alias("weight"))
    # the water level if exactly the sources before this one are full; the first that holds it is right
    water = (F.col("words") * share - (F.col("tops") - top)) / (F.col("weight") - F.col("ws") + F.col("w"))
    order = F.struct("level", F.col("source").isNull(), "source")
    held = per.join(F.broadcast(total)).withColumn("water", water)
    held = held.agg(F.min_by("water", F.when(F.col("water") <= F.col("level"), order)).alias("water"))
    part = F.col("water") * F.col("w")
    return per.join(F.broadcast(held)).select(
        "source", "source_size", F.when(part < top, part).otherwise(top.cast("double")).alias("target"))


def inclusions(sizes: DataFrame, goal: DataFrame, *, cap: int = 2) -> DataFrame:
    """Per source and class: ``expected`` copies, with ``rest``, the source's
    target without the certain copies. One row per source and class."""
    per = sizes.groupBy("source", "class").agg(F.sum("size").alias("class_size"))
    goal = goal.select(F.col("source").alias("of"), "source_size", "target")
    per = per.join(goal, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    own = Window.partitionBy("source")
    before = own.orderBy(F.desc("class")).rowsBetween(Window.unboundedPreceding, -1)
    onward = own.orderBy(F.desc("class")).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    full = F.coalesce(F.sum(cap * F.col("class_size")).over(before), F.lit(0))
    mass = F.sum(F.col("class") * F.col("class_size")).over(onward)
    per = per.withColumn("unit", F.when(mass > 0, (F.col("target") - full) / mass))
    fits = F.col("unit") * F.col("class") <= cap
    per = per.withColumn("unit", F.max(F.when(fits, F.struct("class", "unit"))).over(own)["unit"])
    raw = F.col("unit") * F.col("class")
    per = per.withColumn("expected", F.coalesce(F.when(raw < cap, raw).otherwise(F.lit(float(cap))), F.lit(0.0)))
    per = per.withColumn("whole", F.floor("expected"))
    return per.withColumn("rest", F.col("target") - F.sum(F.col("whole") * F.col("class_size")).over(own))


def _rank(draw: Column, part: Column) -> Column:
    """Random odds over inclusion odds."""
    return (draw / (1 - draw)) / (part / (1 - part))


def sample(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           share: float = 1.5, cap: int = 2, weights: tuple[int, ...] = SOURCE_WEIGHTS, seed: str = "mix:",
           into: str | None = None) -> DataFrame:
    """``docs`` with one more column ``into``, a struct: ``size,
    source_size`` (long), ``target`` (double), ``copies`` (0 .. ``cap``) and
    ``taken`` (``copies * size``). Nothing is dropped. NULL texts have size 0,
    a NULL source is a source of its own, and a document without words is
    never taken. ``into`` is ``mix`` unless given, with underscores added
    where docs has such a column."""
    into = into or free_name(docs.columns, "mix")
    own, of = into, free_name([*docs.columns, into], "mix_of")
    size = word_count(F.col(f"`{text_col}`"))
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), size.alias("size"))
    narrow = narrow.withColumn("class", size_class(F.col("size")))
    goal = targets(narrow, share=share, cap=cap, weights=weights)
    classes = inclusions(narrow, goal, cap=cap)

    part = F.col("expected") - F.col("whole")
    shares = classes.select(F.col("source").alias("of"), F.col("class").alias("in"), "expected", "whole", "rest")
    ranked = (narrow.where("size > 0").join(shares, F.col("source").eqNullSafe(F.col("of")) & (F.col("class") == F.col("in")))
              .where(part > 0).withColumn("rank", _rank(uniform(F.col("id"), seed), part))
              .groupBy("source", "rank").agg(F.sum("size").alias("size"), F.first("rest").alias("rest")))
    summed = positions(ranked, ["source"], [F.col("rank")], sums={"upto": F.col("size")}, position=None)
    inside = F.col("upto") - F.col("size") / 2 <= F.col("rest")
    cuts = summed.groupBy("source").agg(F.max(F.when(inside, F.col("rank"))).alias("cut"))
    cuts = cuts.select(F.col("source").alias("at"), "cut")
    table = (classes.join(cuts, F.col("source").eqNullSafe(F.col("at")), "left")
             .select(F.struct("source", "class", "source_size", "target", "expected", "whole", "cut").alias(of)))

    key = F.struct(size.alias("size"), uniform(F.col(f"`{id_col}`"), seed).alias("draw"))
    doc, part_of = F.col(f"`{own}`"), F.col(f"`{of}`")
    joined = docs.withColumn(own, key).join(table, F.col(f"`{source_col}`").eqNullSafe(part_of["source"])
                                            & (size_class(doc["size"]) == part_of["class"]), "left")
    frac = part_of["expected"] - part_of["whole"]
    extra = F.when((frac > 0) & (_rank(doc["draw"], frac) <= part_of["cut"]), 1).otherwise(0)
    copies = F.when(doc["size"] > 0, part_of["whole"] + extra).otherwise(0).cast("int")
    final = F.struct(doc["size"].alias("size"), part_of["source_size"].alias("source_size"),
                     part_of["target"].alias("target"), copies.alias("copies"), (copies * doc["size"]).alias("taken"))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], final.alias(into))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document's row as often as it is taken."""
    into = free_name(docs.columns, "mix")
    copies = F.col(f"`{into}`")["copies"]
    rows = sample(docs, into=into, **options).where(copies > 0)
    times = F.explode(F.array_repeat(F.lit(0), copies))
    return rows.withColumn(into, times).select(*[F.col(f"`{c}`") for c in docs.columns])
