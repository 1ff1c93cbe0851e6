"""How far sources of a language diverge in their words: one-hot level products.

A group is a (language, source). A kept term's count in a group is its
*level*; its probability there depends on the group and the level only. So the
divergence of two groups, a sum over all kept terms of the language, is a sum
over pairs of levels of the price of such a pair times the number of terms that
have these two levels: their *joint table*.

1. :func:`counts` counts terms by group (whole texts, pre-aggregated by Arrow
   batch, then by task).
2. Kept terms are dealt out by language, bit length of the term's total and
   hash, so terms of a part have few levels. Groups are cut into blocks too,
   and a part holds the groups of two blocks.
3. :func:`joint_prices`: a part's terms, by rising total, are cut into blocks
   of few levels. A block is a matrix of indicator columns, one for each
   (group, level), level 0 included; its transpose times itself holds every
   joint table of the block's groups at once, exactly (whole numbers in single
   precision). Cells that are not 0 are priced in 64-bit numbers.
4. Prices are added up by pair of groups. Terms that occur in neither of two
   blocks of groups have level 0 in all of them and are priced by their number.

Probabilities are whole numbers of ``1 / SCALE``:
``1 + floor(SCALE * (count + ALPHA) / (N + ALPHA * V))``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import positions, top_n_per_group
from ..session import cut_lineage
from .common import bounded, runs, table_of

SCALE, ALPHA = 1_000_000_000, 2
#: Rows (term, group) of a part, groups of a block, columns and cells of a matrix.
PART_ROWS, GROUPS, COLUMNS, CELLS = 32_768, 128, 512, 1 << 23


# ------------------------------------------------------------ counts

def _letter_bytes() -> np.ndarray:
    """What each byte of a text becomes: A-Z their lower case, other ASCII
    characters but a-z a blank, bytes of other characters themselves."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    for first, last in ((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):  # fixed values
        table[first: last + 1] = 32
    return table


def split_terms(texts: pa.Array) -> pa.ListArray:
    """The terms of each text: runs of ASCII letters and non-ASCII characters."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    raw = _letter_bytes()[np.frombuffer(data or b"", np.uint8)]
    plain = pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, pa.py_buffer(raw)], offset=texts.offset)
    parts = pc.ascii_split_whitespace(pc.ascii_trim(plain, characters=" "))
    return parts


def _count_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    parts = split_terms(batch.column("text"))
    ends = parts.offsets.to_numpy()
    coded = parts.flatten().dictionary_encode()
    width = max(len(coded.dictionary), 1)
    word = coded.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(batch.num_rows), np.diff(ends))
    real = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0  # a blank text splits into one empty part
    keep = real[word] if len(word) else np.zeros(0, bool)
    word, doc = word[keep], doc[keep]
    lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    group = lang.indices.to_numpy().astype(np.int64) * max(len(source.dictionary), 1) + source.indices.to_numpy()
    key, n = np.unique(group[doc] * width + word, return_counts=True)
    pair = np.unique(doc * width + word)
    _, docs = np.unique(group[pair // width] * width + pair % width, return_counts=True)
    group, word = np.divmod(key, width)
    at, of = np.divmod(group, max(len(source.dictionary), 1))
    return table_of(lang=lang.dictionary.take(pa.array(at)), source=source.dictionary.take(pa.array(of)),
                    term=coded.dictionary.take(pa.array(word)).cast(pa.string()), n=pa.array(n, pa.int64()), docs=pa.array(docs, pa.int64()))


def counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term in each group
    and the group's documents that hold it. NULL language, source or text is
    the empty string."""
    plain = lambda c, name: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text", 16 << 20):
            yield _count_batch(batch)

    rows = docs.select(plain(lang_col, "lang"), plain(source_col, "source"), plain(text_col, "text"))
    found = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ------------------------------------------------------------ prices

def chance(count: Column, total: Column, terms: Column) -> Column:
    """Probability of a term in units of ``1 / SCALE`` (NULL without terms)."""
    whole = lambda c: c.cast("decimal(19,0)")
    up, down = F.lit(SCALE).cast("decimal(10,0)") * whole(count + ALPHA), whole(total + ALPHA * terms)
    return F.when(terms > 0, F.call_function("div", up, down) + 1)


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _block_prices(term: np.ndarray, group: np.ndarray, level: np.ndarray, chances: np.ndarray, zero: np.ndarray,
                  first: np.ndarray, second: np.ndarray, out: np.ndarray) -> None:
    """Add a block's prices to ``out`` (groups by groups). Its rows: term and
    group numbers, level, probability; ``zero``: each group's probability of
    level 0. Only pairs of a ``first`` and a ``second`` group count."""
    n, groups = int(term[-1]) + 1 if len(term) else 0, len(zero)
    top = int(level.max()) + 1 if len(level) else 1
    key, at, column = np.unique(group * top + level, return_index=True, return_inverse=True)
    of = np.concatenate([np.arange(groups), key // top])
    p = np.concatenate([zero, chances[at]])
    hot = np.zeros((n, len(of)), np.float32)
    hot[:, :groups] = 1  # level 0, unless the term has a row
    hot[term, group] = 0
    hot[term, groups + column] = 1
    a, b = np.flatnonzero(first[of]), np.flatnonzero(second[of])
    joint = hot[:, a].T @ hot[:, b]
    i, j = np.nonzero(joint)
    i, j, many = a[i], b[j], joint[i, j].astype(np.int64)
    ahead = of[i] < of[j]  # each pair of groups once
    i, j, many = i[ahead], j[ahead], many[ahead]
    off = p[i] - p[j]
    np.add.at(out, (of[i], of[j]), many * (off * off // (p[i] + p[j])))


def joint_prices(term: np.ndarray, group: np.ndarray, level: np.ndarray, chances: np.ndarray, zero: np.ndarray,
                 first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Divergences (groups by groups, above the diagonal) over a part's terms.
    Rows are sorted by term; neighbouring terms have similar counts. A block of
    terms ends where its levels would exceed :data:`COLUMNS`."""
    out = np.zeros((len(zero), len(zero)), np.int64)
    starts = np.flatnonzero(np.r_[True, np.diff(term) != 0]) if len(term) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(term)]
    seen: set[tuple[int, int]] = set()
    pairs = list(zip(group.tolist(), level.tolist()))
    lo = 0
    for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        own = pairs[a:b]
        wide = len(seen.union(own)) if seen else 0
        if k > lo and (wide > COLUMNS or (k - lo) * (wide + len(zero)) > CELLS):
            rows = slice(starts[lo], a)
            _block_prices(np.repeat(np.arange(k - lo), ends[lo:k] - starts[lo:k]), group[rows], level[rows], chances[rows], zero, first, second, out)
            lo, seen = k, set()
        seen.update(own)
    if lo < len(starts):
        rows = slice(starts[lo], len(term))
        _block_prices(np.repeat(np.arange(len(starts) - lo), ends[lo:] - starts[lo:]), group[rows], level[rows], chances[rows], zero, first, second, out)
    return out


_PART = ["lang", "part", "a", "b"]


def _run_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of groups of each part (sorted by part); a part's groups are its
    rows without a term."""
    for rows in runs(batches, _PART):
        head, body = rows.filter(pc.is_null(rows["term"])).combine_chunks(), rows.filter(pc.is_valid(rows["term"])).combine_chunks()
        column = lambda t, c: t[c].chunk(0) if t[c].num_chunks else pa.array([], t[c].type)
        names, block = column(head, "source"), column(head, "block").to_numpy()
        one, two = head["a"][0].as_py(), head["b"][0].as_py()
        group = pc.index_in(column(body, "source"), value_set=names).to_numpy().astype(np.int64)
        term = column(body, "term").dictionary_encode().indices.to_numpy().astype(np.int64)
        level, p = column(body, "n").to_numpy(), column(body, "p").to_numpy()
        zero = column(head, "p").fill_null(1).to_numpy()
        first, second = block == one, block == two
        found = joint_prices(term, group, level, p, zero, first, second)
        if one != two:  # the smaller name may be of either block
            found += joint_prices(term, group, level, p, zero, second, first)
        i, j = np.nonzero(np.triu(first[:, None] & second | second[:, None] & first, 1))
        off = zero[i] - zero[j]
        same = lambda value, kind: pa.array([value] * len(i), kind)
        yield table_of(lang=same(head["lang"][0].as_py(), pa.string()), source=names.take(pa.array(i)), other=names.take(pa.array(j)),
                       value=pa.array(found[i, j]), seen=same(int(term[-1]) + 1 if len(term) else 0, pa.int64()),
                       terms=same(head["total"][0].as_py(), pa.int64()), unseen=pa.array(off * off // (zero[i] + zero[j])))


# ------------------------------------------------------------ the audit

def audit(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 10,
          top: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every occurring group.

    ``pair``: the divergence ``floor((p - q)^2 / (p + q))``, summed over all
    terms found in ``min_docs`` documents of the language, from each other
    source of it, largest first. ``term``: the ``top`` terms of the group
    that are likelier there than in its language and diverge most. Ties go to
    the smaller item by UTF-8 bytes. NULL language, source or text is the
    empty string, so a group of its own; a language without kept terms has
    pairs of value 0 and no terms; repeated rows count each; no rows give no
    rows. Columns are read by the given names only."""
    per = cut_lineage(counts(docs, text_col=text_col, lang_col=lang_col, source_col=source_col))
    words = per.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    kept = cut_lineage(per.join(words.drop("docs"), ["lang", "term"]))

    plain = lambda c, name: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
    groups = docs.select(plain(lang_col, "lang"), plain(source_col, "source")).distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_size"))
    vocabulary = kept.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / GROUPS).cast("long").alias("blocks"))
    none = {c: F.coalesce(c, F.lit(0)) for c in ("size", "lang_size", "terms")}
    groups = (groups.join(blocks, "lang").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
              .join(vocabulary, "lang", "left").withColumns(none)
              .withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks"))))
    groups = cut_lineage(groups)

    rows = kept.join(groups, ["lang", "source"])
    rows = cut_lineage(rows.withColumn("p", chance(F.col("n"), F.col("size"), F.col("terms")))
                       .withColumn("class", F.length(F.bin("total")).cast("long")))
    parts = rows.groupBy("lang", "class").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("long").alias("of"))
    number = lambda deal: F.col("class") * F.lit(1 << 40) + deal
    met = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))  # the other block of each part
    ends = [F.least("block", "met").alias("a"), F.greatest("block", "met").alias("b")]
    body = (rows.join(parts, ["lang", "class"]).withColumn("met", met)
            .select("lang", number(F.pmod(F.xxhash64("term"), F.col("of"))).alias("part"), *ends, "block", "source", "term", "total", "n", "p"))
    deals = F.transform(F.sequence(F.lit(0).cast("long"), F.col("of") - 1), number)
    every = parts.select("lang", F.explode(deals).alias("part"))
    every = every.union(blocks.select("lang", F.lit(-1).cast("long")))  # a part of each language has no terms
    head = groups.withColumn("met", met).join(every, "lang").select(
        "lang", "part", *ends, "block", "source", F.lit(None).cast("string").alias("term"), F.col("terms").alias("total"),
        F.lit(0).cast("long").alias("n"), chance(F.lit(0), F.col("size"), F.col("terms")).alias("p"))
    dealt = body.union(head).repartition(*_PART).sortWithinPartitions(*_PART, F.col("term").isNotNull(), "total", "term", "source")
    priced = dealt.mapInArrow(_run_parts, "lang string, source string, other string, value long, seen long, terms long, unseen long")
    summed = priced.groupBy("lang", "source", "other").agg(
        (F.sum("value") + (F.max("terms") - F.sum("seen")) * F.max("unseen")).alias("value"))
    turned = F.explode(F.array(F.struct(F.col("source").alias("of"), F.col("other").alias("item")),
                               F.struct(F.col("other").alias("of"), F.col("source").alias("item"))))
    pairs = summed.select("lang", turned.alias("x"), "value").select("lang", F.col("x.of").alias("source"), F.col("x.item").alias("item"), "value")
    pairs = positions(pairs, ["lang", "source"], [F.desc("value"), F.col("item")], position="rank")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", (F.col("rank") + 1).cast("int").alias("rank"))

    q = chance(F.col("total"), F.col("lang_size"), F.col("terms"))
    above = rows.withColumn("q", q).where("p > q").select("lang", "source", F.col("term").alias("item"), price(F.col("p"), F.col("q")).alias("value"))
    best = top_n_per_group(above, ["lang", "source"], [F.desc("value"), F.col("item")], top, rank="rank")
    return pairs.union(best.select("lang", "source", F.lit("term").alias("part"), "item", "value", F.col("rank").cast("int")))
