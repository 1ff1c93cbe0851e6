"""Text operators: token buckets, rare and significant terms, BM25 relevance
ranking and more-like-this.

Document frequencies are computed from each document's *distinct* tokens, so a
term is counted once per document. The operators take their input as it is
partitioned: tokenizing runs in the scan tasks. All term statistics are ``groupBy(term)``
aggregates with map-side partial aggregation: frequent terms ("the", in a
third of all documents) are pre-combined per task before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import null_safe
from ..functions.text import analyze, distinct_tokens, tokens
from ..session import cut_lineage

# BM25 parameters (the published defaults).
BM25_K1 = 1.2
BM25_B = 0.75


#: Liked terms that may be broadcast (a few MB).
BROADCAST_TERMS = 100_000


def doc_terms(df: DataFrame, text_field: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per (document, distinct token)."""
    return df.select(*keep, F.explode(distinct_tokens(text_field)).alias("term"))


def token_terms(df: DataFrame, text_field: str, size: int | None = None) -> DataFrame:
    """Terms buckets over analysed text: bucket = token, a document counts once
    per token. Ordered by doc_count desc, key asc."""
    out = doc_terms(df, text_field).groupBy(F.col("term").alias("key")).agg(F.count("*").alias("doc_count"))
    out = out.orderBy(F.col("doc_count").desc(), F.col("key").asc())
    return out.limit(size) if size is not None else out


def rare_terms(df: DataFrame, text_field: str, max_doc_count: int = 1) -> DataFrame:
    """Tokens present in at most ``max_doc_count`` documents."""
    out = doc_terms(df, text_field).groupBy(F.col("term").alias("key")).agg(F.count("*").alias("doc_count"))
    return out.filter(F.col("doc_count") <= max_doc_count).orderBy("doc_count", "key")


def significant_terms(df: DataFrame, text_field: str, foreground: Column, size: int | None = None,
                      min_doc_count: int = 1) -> DataFrame:
    """Tokens over-represented in the foreground set (rows matching
    ``foreground``) against all rows (the background).

    score = (fg_pct - bg_pct) * fg_pct / bg_pct with fg_pct = fg_count/fg_total
    and bg_pct = bg_count/bg_total. One pass: each (document, token) row
    carries a foreground flag, so foreground and background counts come out of
    the same aggregate; the two totals are a one-row aggregate."""
    flagged = df.select(null_safe(foreground).alias("_fg"), F.explode(distinct_tokens(text_field)).alias("term"))
    totals = df.agg(F.count("*").alias("bg_total"),
                    F.sum(null_safe(foreground).cast("long")).alias("fg_total")).first()
    bg_total, fg_total = totals["bg_total"], totals["fg_total"] or 0
    counts = flagged.groupBy(F.col("term").alias("key")).agg(
        F.sum(F.col("_fg").cast("long")).alias("doc_count"),
        F.count("*").alias("bg_count"))
    fg_pct = F.col("doc_count") / F.lit(float(fg_total) if fg_total else float("nan"))
    bg_pct = F.col("bg_count") / F.lit(float(bg_total))
    out = (counts.filter(F.col("doc_count") >= min_doc_count)
                 .withColumn("score", (fg_pct - bg_pct) * fg_pct / bg_pct)
                 .filter(F.col("score") > 0))
    out = out.orderBy(F.col("score").desc(), F.col("key").asc())
    return out.limit(size) if size is not None else out


def _per_doc(df: DataFrame, text_field: str, q: list[str]) -> DataFrame:
    """Tokenize once; keep the document length and, per query term, its
    occurrence count (length minus the length without that term: built-in,
    code-generated array functions, no lambda)."""
    out = df.withColumn("_toks", tokens(text_field)).withColumn("_dl", F.size("_toks"))
    out = out.withColumns({f"_tf{i}": (F.col("_dl") - F.size(F.array_remove("_toks", t))).cast("double")
                           for i, t in enumerate(q)})
    return out.drop("_toks")


def bm25_scores(df: DataFrame, text_field: str, query: str, k1: float = BM25_K1, b: float = BM25_B,
                stats_df: DataFrame | None = None, materialize: bool = False) -> DataFrame:
    """Adds ``score`` = BM25 of ``query`` against each row's text.

    idf(t) = ln(1 + (N - df + 0.5)/(df + 0.5)); tf = occurrences of t in the
    document; dl = tokens in the document; avgdl over the collection.

    The query has a handful of terms, known on the driver, so the collection
    statistics (N, avgdl and df of each query term) are ONE global aggregate
    returning one row, and the score is a column expression: no term table,
    no join, no shuffle besides the final top-k. ``stats_df`` lets the
    collection statistics come from a larger frame than the one scored.
    ``materialize=True`` checkpoints the per-document numbers (the text is
    dropped first) so the statistics and the scoring read them instead of
    tokenizing the corpus twice."""
    q = list(dict.fromkeys(analyze(query)))
    per = _per_doc(df, text_field, q)
    if materialize:
        per = cut_lineage(per.drop(text_field))
    coll = _per_doc(stats_df, text_field, q) if stats_df is not None else per
    aggs = [F.count("*").alias("n"), F.avg("_dl").alias("avgdl")]
    aggs += [F.sum((F.col(f"_tf{i}") > 0).cast("long")).alias(f"df{i}") for i in range(len(q))]
    st = coll.agg(*aggs).first()
    n, avgdl = st["n"], st["avgdl"] or 1.0
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("_dl") / F.lit(float(avgdl)))
    score = F.lit(0.0)
    for i in range(len(q)):
        dfreq = st[f"df{i}"] or 0
        idf = math.log(1.0 + (n - dfreq + 0.5) / (dfreq + 0.5))
        tf = F.col(f"_tf{i}")
        score = score + F.lit(idf) * tf * F.lit(k1 + 1.0) / (tf + norm)
    return per.withColumn("score", score).drop("_dl", *[f"_tf{i}" for i in range(len(q))])


def bm25_top_k(df: DataFrame, text_field: str, query: str, k: int, id_field: str,
               keep: Sequence[str] = (), min_score: float = 0.0) -> DataFrame:
    """Best ``k`` documents by BM25 (ties by id); rows with score <= min_score
    (no query term) do not match. Top-k runs as a distributed
    TakeOrderedAndProject: each task keeps its own k best. The corpus is
    tokenized once (per-document numbers are checkpointed).

    The score filter is applied *after* the top-k: non-matching rows score 0
    and sort last, so the result is the same, and a filter above a limit is
    not pushed down into the projection (where it would re-run the
    tokenizer once per reference)."""
    scored = bm25_scores(df.select(id_field, text_field, *keep), text_field, query, materialize=True)
    top = scored.select(id_field, *keep, "score").orderBy(F.col("score").desc(), F.col(id_field).asc()).limit(k)
    return top.filter(F.col("score") > min_score)


def more_like_this(df: DataFrame, text_field: str, id_field: str, like_id, k: int = 10,
                   max_query_terms: int | None = None, min_doc_freq: int = 1, max_doc_freq_ratio: float = 1.0,
                   min_term_freq: int = 1, minimum_should_match: int = 1) -> DataFrame:
    """Documents sharing the most informative tokens with document ``like_id``.

    No term is left out unless asked for (``min_doc_freq``,
    ``max_doc_freq_ratio``, ``max_query_terms``).

    1. tokens of the liked document with their term frequency. Up to
       :data:`BROADCAST_TERMS` of them go to the documents as one broadcast
       array; more are joined as a table;
    2. every document keeps the liked terms it holds as one array (an
       intersection, no row per term), checkpointed without its text;
    3. document frequency per liked term from those arrays, and the terms
       that pass the limits, best by tf*ln(N/df), ties by term;
    4. documents ranked by the number of such terms they hold, then id.
    """
    like = (df.filter(F.col(id_field) == F.lit(like_id))
              .select(F.explode(tokens(text_field)).alias("term"))
              .groupBy("term").agg(F.count("*").alias("tf"))
              .filter(F.col("tf") >= min_term_freq))
    like = cut_lineage(like)
    if like.count() <= BROADCAST_TERMS:
        liked = F.broadcast(like.agg(F.collect_list("term").alias("_liked")))
        held = df.select(id_field, distinct_tokens(text_field).alias("_own")).join(liked).select(
            id_field, F.array_intersect("_own", "_liked").alias("_held"))
    else:
        held = (doc_terms(df, text_field, keep=[id_field]).join(like, "term").groupBy(id_field)
                .agg(F.collect_list("term").alias("_held")))
    held = cut_lineage(held)
    n = df.count()
    freq = held.select(F.explode("_held").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    cand = (freq.join(like, "term")
                .filter((F.col("df") >= min_doc_freq) & (F.col("df") <= F.lit(max_doc_freq_ratio * n)))
                .withColumn("w", F.col("tf") * F.log(F.lit(float(n)) / F.col("df"))))
    if max_query_terms is not None:
        cand = cand.orderBy(F.col("w").desc(), F.col("term").asc()).limit(max_query_terms)
    # at most as many terms as the liked document has
    hits = held.filter(F.col(id_field) != F.lit(like_id)).select(id_field, F.explode("_held").alias("term"))
    shared = (hits.join(cand.select("term"), "term").groupBy(id_field).agg(F.count("*").alias("shared_terms"))
                  .filter(F.col("shared_terms") >= minimum_should_match))
    return shared.orderBy(F.col("shared_terms").desc(), F.col(id_field).asc()).limit(k)
