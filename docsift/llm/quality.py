"""Quality rules over whole texts, in DataFrame functions only.

* :func:`base_features`: word, symbol, line and repetition counts.
* :func:`fit`: counts of hashed word 1- and 2-grams over the distinct texts of
  all documents (raw corpus) and of the trusted ones (target). The number of
  buckets follows the target's size up to ``max_buckets``. Counting
  pre-aggregates in each task, so at most that many rows of each task are
  shuffled; the model is a one-row table of one number a bucket and never
  passes through the driver or a plan's text.
* :func:`score`: the log-likelihood ratio between the two multinomials of a
  document's n-grams, divided by their number. Words are compared by 64-bit
  hashes.

A bucket with ``t`` target grams of ``T`` and ``r`` raw ones of ``R`` has the
ratio ``ln((t + a) / (e + a)) + e / (2 (e + a)^2)`` with ``e = T (r - 1) / (R - 1)``:
both multinomials at the target's size, smoothed by ``a``. The gram that is being
scored is left out of the raw counts, and the second term takes out what
sampling ``t`` around ``e`` adds to the mean of the logarithm. So a document
that is like the target has a ratio of 0 or more on average whatever the
corpus, and one threshold serves every size. Copies of a text count once, so
groups of copies do not outweigh the target.

Empty and NULL texts have no words, a ratio of 0, and fail the base rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import WORD_GAP, free_name

#: White space characters of the word rule (fixed values).
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"


def _let(value: Column, body) -> Column:
    """``body`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_array(text: Column) -> Column:
    """The words of a text: runs of anything but white space (NULL: none)."""
    inner = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return _let(inner, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WORD_GAP)))


def _windows(n: Column, width: int) -> Column:
    """Start places of the windows of ``width`` among ``n`` items."""
    return F.when(n >= width, F.sequence(F.lit(0), n - width)).otherwise(F.array().cast("array<int>"))


def repeat_words(hashes: Column) -> Column:
    """Words that lie in a 3-word window found twice or more. Windows are
    sorted by value, those with an equal neighbour are the repeated ones, and
    their places in order give the words covered: n log n steps in all."""
    def covered(starts: Column) -> Column:
        zero = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        step = lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"))
        return F.aggregate(starts, zero, step, lambda a: a["n"])

    def places(s: Column) -> Column:
        same = lambda e, j: F.get(s, j)["h"] == e["h"]
        twice = lambda e, i: F.coalesce(same(e, i - 1), F.lit(False)) | F.coalesce(same(e, i + 1), F.lit(False))
        return F.sort_array(F.transform(F.filter(s, twice), lambda e: e["i"]))

    def count(t: Column) -> Column:
        pairs = F.sort_array(F.transform(t, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(t)) == F.size(t), F.lit(0)).otherwise(covered(_let(pairs, places)))

    triples = _let(hashes, lambda h: F.transform(
        _windows(F.size(h), 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2))))
    return _let(triples, count)


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.trim(x, F.lit(BLANKS)) != "")
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _grams(hashes: Column, buckets: int) -> Column:
    """Buckets of a text's word 1-grams and 2-grams."""
    one = lambda h: F.transform(h, lambda x: F.pmod(x, F.lit(buckets)).cast("int"))
    two = lambda h: F.transform(_windows(F.size(h), 2), lambda i: F.pmod(
        F.xxhash64(F.get(h, i), F.get(h, i + 1)), F.lit(buckets)).cast("int"))
    return _let(hashes, lambda h: F.concat(one(h), two(h)))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


@dataclass(frozen=True)
class RatioModel:
    """One-row table ``ratios``: the log ratio of target to raw probability of
    each of ``buckets`` buckets."""

    table: DataFrame
    buckets: int

    def column(self) -> Column:
        """The ratios as one constant array."""
        return self.table.scalar()


def _buckets(target_bytes: int, least: int, most: int) -> int:
    """A power of two: about eight target grams a bucket, as a text has about
    a gram for each three bytes."""
    wanted = max(target_bytes // 24, 1)
    return min(max(1 << (wanted - 1).bit_length(), least), most)


def fit(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        min_buckets: int = 1 << 10, max_buckets: int = 1 << 17, alpha: float = 1.0) -> RatioModel:
    """``trusted``: the ids (``id_col``) of the target's documents; repeated
    and NULL ids count once and never. A text is of the target if any of its
    copies is. Without trusted words every ratio is 0. Hashes,
    ids and lengths are compared to find copies; of each text the
    document with the smallest id (NULL if there is no other) is counted, and
    repeated rows of that document count each."""
    marks = trusted.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct().withColumn("hit", F.lit(1))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL")
    keys = rows.select("id", F.xxhash64("text").alias("key"), F.octet_length("text").cast("long").alias("size"))
    once = cut_lineage(keys.join(marks, "id", "left").groupBy("key", "size").agg(F.min("id").alias("of"), F.max("hit").alias("hit")))
    size = once.agg(F.sum(F.when(F.col("hit") == 1, F.col("size")))).first()[0]
    buckets = _buckets(size or 0, min_buckets, max_buckets)
    # only the ids are built into a hash table; the texts are not sorted
    reps = once.select("of", "key", "hit").hint("shuffle_hash")
    same = F.col("id").eqNullSafe(F.col("of")) & (F.xxhash64("text") == F.col("key"))
    grams = rows.join(reps, same).select("hit", F.explode(_grams(_hashes(word_array(F.col("text"))), buckets)).alias("g"))
    counts = cut_lineage(grams.groupBy("g").agg(F.count(F.lit(1)).alias("raw"), F.count("hit").alias("target")))
    total = counts.agg(F.sum("raw").alias("raws"), F.sum("target").alias("targets"))
    every = docs.sparkSession.range(buckets).toDF("place")
    known = every.join(counts, F.col("place") == F.col("g"), "left").join(F.broadcast(total))  # one row of totals
    mean = F.col("targets") * F.greatest(F.coalesce("raw", F.lit(0)) - 1, F.lit(0)) / F.greatest(F.col("raws") - 1, F.lit(1))
    known = known.select("place", "targets", F.coalesce("target", F.lit(0)).alias("t"), mean.alias("e"))
    ratio = F.log((F.col("t") + alpha) / (F.col("e") + alpha)) + F.col("e") / (2 * (F.col("e") + alpha) * (F.col("e") + alpha))
    known = known.select(F.struct("place", F.when(F.col("targets") > 0, ratio).otherwise(F.lit(0.0)).alias("ratio")).alias("x"))
    # at most max_buckets numbers in one row
    table = known.agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["ratio"]).alias("ratios"))
    return RatioModel(cut_lineage(table), buckets)


def score(docs: DataFrame, model: RatioModel, *, text_col: str = "text", threshold: float = -0.2,
          min_words: int = 50, max_repeat_percent: int = 50, into: str | None = None) -> DataFrame:
    """``docs`` with one more column ``into``, a struct: ``n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long),
    ``base_failed, ratio, kept``. Row by row: no shuffle. Repeated rows get
    equal verdicts, an empty table stays empty. ``into``
    is ``quality`` unless given, with underscores added where docs has such a
    column."""
    into = into or free_name(docs.columns, "quality")
    text = F.col(f"`{text_col}`")

    def features(w: Column, h: Column, ratios: Column) -> Column:
        n = F.size(w).cast("long")
        rep = repeat_words(h).cast("long")
        total = _let(_grams(h, model.buckets), lambda g: F.when(F.size(g) == 0, F.lit(0.0)).otherwise(
            F.aggregate(g, F.lit(0.0), lambda a, x: a + F.get(ratios, x)) / F.size(g)))
        return F.struct(n.alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        rep.alias("n_repeat_words"), total.alias("ratio"))

    held = free_name([*docs.columns, into], "ratios")
    both = F.struct(word_array(text).alias("w"), F.col(f"`{held}`").alias("r"))
    part = _let(both, lambda x: _let(_hashes(x["w"]), lambda h: features(x["w"], h, x["r"])))
    whole = F.coalesce(text, F.lit(""))
    symbols = (F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, ""))).cast("long")
    lines = duplicate_lines(text).cast("long")

    def verdict(p: Column) -> Column:
        failed = (p["n_words"] < min_words) | (100 * p["n_repeat_words"] > max_repeat_percent * p["n_words"])
        return F.struct(p["n_words"].alias("n_words"), p["word_chars"].alias("word_chars"), symbols.alias("n_symbols"),
                        lines.alias("n_dup_lines"), p["n_repeat_words"].alias("n_repeat_words"),
                        failed.alias("base_failed"), p["ratio"].alias("ratio"),
                        (~failed & (p["ratio"] >= threshold)).alias("kept"))

    return docs.withColumn(held, model.column()).withColumn(into, _let(part, verdict)).drop(held)
