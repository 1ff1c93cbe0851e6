"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A text is the bag of the character 3- to 5-grams of its words (lower-cased,
with word borders), hashed into a fixed number of buckets. Each bucket has an
embedding; their mean goes into a linear softmax. Embeddings and softmax are
trained together in numpy on a bounded sample of labelled rows, so a
misspelling never seen shares the vectors of its character n-grams. Scoring
uses one number per bucket (embedding times weight difference) and computes
each distinct word of a batch once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, table_of

SIZES = (3, 4, 5)


def subwords(words: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of each word (borders included), one
    word after another, and how many each word has (none if it is empty)."""
    joined = "".join(f"\x02{w}\x03" for w in words.to_pylist())
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    start = np.flatnonzero(codes == 2)
    length = np.diff(np.append(start, len(codes)))
    left = np.repeat(start + length, length) - np.arange(len(codes))  # characters to the word's end
    marks, hashes = [], []
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, max(SIZES) + 1):
        moved = np.zeros(len(codes), np.uint64)
        moved[: max(len(codes) - n + 1, 0)] = codes[n - 1:]
        h = h * np.uint64(0x100000001B3) + moved + np.uint64(1)
        if n in SIZES:
            marks.append(left >= n)
            mixed = (h ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            hashes.append((mixed >> np.uint64(40)) % np.uint64(buckets))
    mask = np.stack(marks, 1)
    counts = np.add.reduceat(mask.sum(1), start) if len(start) else np.zeros(0, np.int64)
    return np.stack(hashes, 1)[mask].astype(np.int64), counts


def text_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Word numbers of all texts, the distinct words, and text offsets. Words
    are lower-cased runs of anything but ASCII white space, without marks at
    their ends."""
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    lower = pc.replace_substring_regex(lower, "[\\x00-\\x08\\x0e-\\x1f]", " ")
    parts = pc.ascii_split_whitespace(pc.ascii_trim(lower, characters=" \t\n\x0b\x0c\r"))
    coded = parts.values.dictionary_encode()
    trimmed = pc.utf8_trim(coded.dictionary, characters=".,;:!?\"'()[]|*#&%$-").dictionary_encode()
    offsets = parts.offsets.to_numpy()
    return trimmed.indices.to_numpy()[coded.indices.to_numpy()], trimmed.dictionary, offsets - offsets[0]


def text_bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Text number, word number and weight of every distinct word of every
    text, and the words. A word found ``k`` times weighs ``sqrt(k)``: a text
    that repeats one word is not judged by it alone."""
    at, distinct, offsets = text_words(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    pair, times = np.unique(owner * max(len(distinct), 1) + at, return_counts=True)
    return pair // max(len(distinct), 1), pair % max(len(distinct), 1), np.sqrt(times), distinct


def _gather_sums(values: np.ndarray, index: np.ndarray, starts: np.ndarray, scale: np.ndarray | None = None,
                 rows: int = 500_000) -> np.ndarray:
    """``np.add.reduceat(values[index] * scale, starts)`` in pieces of about
    ``rows`` gathered rows."""
    out = np.empty((len(starts), values.shape[1]), values.dtype)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + rows)))
        a, b = int(starts[lo]), int(starts[hi]) if hi < len(starts) else len(index)
        part = values[index[a:b]]
        if scale is not None:
            part *= scale[a:b]
        out[lo:hi] = np.add.reduceat(part, starts[lo:hi] - a)
        lo = hi
    return out


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float
    pad: float  # subwords without a vote that every text has besides its own

    def score(self, texts: pa.Array) -> np.ndarray:
        owner, word, times, distinct = text_bags(texts)
        grams, counts = subwords(distinct, len(self.weights))
        sums = np.bincount(np.repeat(np.arange(len(counts)), counts), self.weights[grams], len(counts))
        total = np.bincount(owner, sums[word] * times, len(texts))
        n = np.bincount(owner, counts[word] * times, len(texts)) + self.pad
        return 1 / (1 + np.exp(-np.clip(self.bias + total / n, -40, 40)))


def train(texts: list[str], labels: np.ndarray, weights: np.ndarray, *, buckets: int = 1 << 18, dim: int = 6,
          steps: int = 45, rate: float = 1.0, floor: float = 0.05, decay: float = 1e-6, min_texts: int = 5, pad: float = 60,
          seed: int = 11) -> ToxicityModel:
    """Full-batch Adam on embeddings and softmax together. ``weights``: of
    each row. Without rows of both labels the score is the share of label 1
    (0.5 without rows)."""
    share = float((labels * weights).sum() / weights.sum()) if len(labels) else 0.5
    if not len(labels) or labels.min() == labels.max():
        share = min(max(share, 1e-6), 1 - 1e-6)
        return ToxicityModel(np.zeros(buckets, np.float32), float(np.log(share / (1 - share))), pad)
    rng = np.random.default_rng(seed)
    owner, word, times, distinct = text_bags(pa.array(texts))
    parts = [subwords(distinct.slice(lo, 50_000), buckets) for lo in range(0, len(distinct), 50_000)]
    grams = np.concatenate([g.astype(np.int32) for g, _ in parts] or [np.zeros(0, np.int32)])
    counts = np.concatenate([c for _, c in parts] or [np.zeros(0, np.int64)])
    del parts
    size = (np.bincount(owner, counts[word] * times, len(texts)) + pad).astype(np.float32)[:, None]
    # texts that hold a subword, counted by its words
    texts_of = np.bincount(grams, np.repeat(np.bincount(word, minlength=len(counts)), counts), buckets)
    kept = texts_of[grams] >= min_texts
    if not kept.any():
        kept[:] = True
    by_word = np.repeat(np.arange(len(counts), dtype=np.int32), counts)[kept]  # words of the kept subwords, in order
    used, grams = np.unique(grams[kept], return_inverse=True)
    grams = grams.astype(np.int32)
    has, first = np.unique(by_word, return_index=True)
    by_gram = np.argsort(grams, kind="stable").astype(np.int32)
    word_of_gram = by_word[by_gram]
    gram_first = np.searchsorted(grams[by_gram], np.arange(len(used), dtype=np.int32))
    del by_gram, by_word
    own, starts = np.unique(owner, return_index=True)
    sort = np.argsort(word, kind="stable")
    owner_by_word, times_by_word = owner[sort], times[sort].astype(np.float32)[:, None]
    seen, word_first = np.unique(word[sort], return_index=True)
    times = times.astype(np.float32)[:, None]

    emb = rng.normal(0, 0.1, (len(used), dim)).astype(np.float32)
    soft = rng.normal(0, 0.5, (dim, 2)).astype(np.float32)
    bias = np.log(np.asarray([1 - share, share], np.float32))
    target = np.eye(2, dtype=np.float32)[labels]
    w = (weights / weights.sum()).astype(np.float32)[:, None]
    params = [emb, soft, bias]
    mean = [np.zeros_like(p) for p in params]
    square = [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        vector = np.zeros((len(counts), dim), np.float32)
        vector[has] = _gather_sums(emb, grams, first)
        doc = np.zeros((len(texts), dim), np.float32)
        doc[own] = _gather_sums(vector, word, starts, times)
        doc /= size
        logit = doc @ soft + bias
        logit -= logit.max(1, keepdims=True)
        p = np.exp(logit)
        p /= p.sum(1, keepdims=True)
        d = (p - target) * w
        back = (d @ soft.T) / size
        word_back = np.zeros((len(counts), dim), np.float32)
        word_back[seen] = _gather_sums(back, owner_by_word, word_first, times_by_word)
        grads = [_gather_sums(word_back, word_of_gram, gram_first) + decay * emb, doc.T @ d, d.sum(0)]
        for i, (x, g) in enumerate(zip(params, grads)):
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.99 * square[i] + 0.01 * g * g
            scale = np.sqrt(square[i] / (1 - 0.99 ** step))
            x -= (rate, 0.2 * rate, 0.1 * rate)[i] * (mean[i] / (1 - 0.9 ** step)) / (scale + floor * scale.max() + 1e-12)
    flat = np.zeros(buckets, np.float32)
    flat[used] = emb @ (soft[:, 1] - soft[:, 0])
    return ToxicityModel(flat, float(bias[1] - bias[0]), pad)


def _shortened(id: Column, text: Column, max_chars: int) -> Column:
    """A text of more than ``max_chars`` characters as a sample of about that
    many, words drawn by a hash from all over it (a word of over 64 characters
    in pieces); shorter ones as they are."""
    pieces = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]{1,64})"), F.lit(1))
    drawn = F.element_at(F.transform(F.array(F.length(text)), lambda n: F.filter(  # the length once per text
        pieces, lambda w, i: F.pmod(F.xxhash64(id, i), n) < max_chars)), 1)
    return F.when(F.length(text) <= max_chars, text).otherwise(F.array_join(drawn, " "))


def _lowest(known: DataFrame, rows_of_label: tuple[int, int]) -> DataFrame:
    """Of each label the rows lowest by a hash of their id; each task keeps
    that many at most."""
    own = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n) for y, n in enumerate(rows_of_label)]
    return own[0].union(own[1]).select("id", "y")


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        rows_of_label: tuple[int, int] = (4000, 2500), max_chars: int = 3000, **options) -> ToxicityModel:
    """Train on ``rows_of_label`` rows of label 0 and 1 at most (lowest by a
    hash of their id, whatever the length of the text), weighted so that the
    labels count as in all of ``labels``. Of a text over ``max_chars``
    characters, words drawn from all over it are used, about that many
    characters, so the driver gets ``max_chars`` of each row at most. NULL ids and labels are
    not used, a repeated id has its largest label. The picked ids (as many as
    that at most) are broadcast to the documents."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .where("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y")))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = _lowest(known, rows_of_label)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text") > 0)
    rows = texts.join(F.broadcast(picked), "id").groupBy("id").agg(
        F.min("text").alias("text"), F.min("y").alias("y")).select(
        "id", "y", _shortened(F.col("id"), F.col("text"), max_chars).alias("text")).orderBy("id").collect()
    y = np.asarray([r["y"] for r in rows], np.int64)
    share = np.asarray([totals[k] / max((y == k).sum(), 1) for k in y.tolist()], np.float64)
    return train([r["text"] for r in rows], y, share, **options)


def score(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row (NULL text: empty, the score of an empty
    bag). Row by row, whole texts, no shuffle; the model goes to the tasks as
    a broadcast of ``buckets`` numbers."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            yield table_of(doc_id=batch.column("doc_id"), score=pa.array(sent.value.score(batch.column("text"))))

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "doc_id long, score double")
