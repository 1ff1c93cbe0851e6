"""Token counts of a unigram segmentation, with a trie shared by pre-tokens.

A vocabulary gives each piece a whole-number weight (thousandths of a log
probability by rank). A pre-token's count is the number of pieces of its best
segmentation: the largest sum of weights, then the fewest pieces.

The distinct pre-tokens of a batch form a trie: sorted, each shares with its
predecessor the path of their common prefix. The forward score of a trie node
(the best segmentation of the prefix it stands for) is computed once, however
many pre-tokens share it, level by level for all nodes of a level at once;
pre-tokens read their counts at their terminal nodes. Texts then add up the
counts of their pre-tokens.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, table_of

#: A score is ``weight * UNIT - pieces``: the larger score is the better one.
UNIT = 1 << 20
#: Longer pre-tokens go through the same recurrence one by one.
TRIE_CHARS = 64
WORD_START = "▁"  # the vocabulary's mark of a word's beginning (fixed value)
_BASE = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores, and what a character in no piece costs for
    each of its UTF-8 bytes (a piece of its own)."""

    scores: dict[str, int]
    byte_score: int

    @classmethod
    def ranked(cls, pieces: list[str]) -> Vocabulary:
        """Weights by rank: ``-log(rank + 1)`` less the normaliser."""
        norm = math.log(sum(1 / (i + 1) for i in range(len(pieces)))) if pieces else 0.0
        weight = [-round(1000 * (math.log(i + 1) + norm)) for i in range(len(pieces))]
        scores: dict[str, int] = {}
        for p, w in zip(pieces, weight):
            scores.setdefault(p, w * UNIT - 1)
        return cls(scores, (min(weight, default=0) - 10_000) * UNIT - 1)

    @classmethod
    def of_model(cls, path: str | None = None) -> Vocabulary:
        """Ordinary pieces of a sentencepiece model, in order of their ids."""
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        return cls.ranked([sp.id_to_piece(i) for i in range(sp.get_piece_size())
                           if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))])


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        scores = vocabulary.scores
        self.longest = max(map(len, scores), default=1)
        codes = [np.frombuffer(p.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1) for p in scores]
        keys = np.asarray([self._hash(c) for c in codes], np.uint64)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces share a 64-bit hash")
        # open addressing: a slot's key is checked, then the next slot's
        self.bits = max(4, int(math.ceil(math.log2(4 * max(len(keys), 1)))))
        self.keys = np.zeros((1 << self.bits) + 64, np.uint64)
        self.values = np.full(len(self.keys), -(1 << 62), np.int64)
        self.probes = 1
        for k, v in zip(keys, scores.values()):
            at = first = int(self._slot(k))
            while self.keys[at]:
                at += 1
            self.keys[at], self.values[at] = k, v
            self.probes = max(self.probes, at - first + 1)

    @staticmethod
    def _hash(codes: np.ndarray) -> np.uint64:
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for c in codes:
                h = h * _BASE + c
        return h

    def _slot(self, key):
        with np.errstate(over="ignore"):
            return ((key * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _lookup(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out = np.full(len(keys), -(1 << 62), np.int64)
        for _ in range(self.probes):
            hit = self.keys[at] == keys
            out[hit] = self.values[at[hit]]
            at += 1
        return out

    def _byte_scores(self, codes: np.ndarray) -> np.ndarray:
        n = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        return n * self.vocabulary.byte_score

    def one(self, token: str) -> int:
        """Pieces of one pre-token by the plain recurrence."""
        scores, longest, least = self.vocabulary.scores, self.longest, self.vocabulary.byte_score
        best = [(0, 0)]
        for d in range(1, len(token) + 1):
            n = len(token[d - 1].encode("utf-8", "surrogatepass"))
            w, c = best[d - 1]
            top = (w + n * ((least + 1) // UNIT), c - n)
            for m in range(1, min(longest, d) + 1):
                s = scores.get(token[d - m: d])
                if s is not None:
                    w, c = best[d - m]
                    top = max(top, (w + (s + 1) // UNIT, c - 1))
            best.append(top)
        return -best[-1][1]

    def trie(self, tokens: list[str]) -> np.ndarray:
        """Pieces of distinct pre-tokens of :data:`TRIE_CHARS` characters at
        most, by the shared trie."""
        order = sorted(range(len(tokens)), key=tokens.__getitem__)
        size = np.asarray([len(tokens[i]) for i in order], np.int64)
        depth = int(size.max(initial=0))
        n = len(order)
        if not depth:
            return np.zeros(n, np.int64)
        grid = np.zeros((n, depth), np.uint32)
        flat = np.frombuffer("".join(tokens[i] for i in order).encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = np.arange(depth) < size[:, None]
        grid[inside] = flat
        differs = np.ones((n, depth), bool)
        differs[1:] = (grid[1:] != grid[:-1]) | ~inside[1:]
        first_new = np.where(differs.any(1), differs.argmax(1), depth)  # characters shared with the predecessor
        counts = np.zeros(n, np.int64)
        window: list[np.ndarray] = [np.zeros(n, np.int64)]  # scores of the last levels, for every pre-token
        hashes: list[np.ndarray] = [np.zeros(n, np.uint64)]
        power = [np.uint64(1)]
        for _ in range(self.longest):
            with np.errstate(over="ignore"):  # hashes are modulo 2**64
                power.append(power[-1] * _BASE)
        for d in range(1, depth + 1):
            char = grid[:, d - 1]
            full = hashes[-1] * _BASE + char.astype(np.uint64) + np.uint64(1)
            node = np.flatnonzero((size >= d) & (first_new < d))  # first pre-token of each node
            top = window[-1][node] + self._byte_scores(char[node])
            for m in range(1, min(self.longest, d) + 1):
                part = full[node] - hashes[-m][node] * power[m]
                np.maximum(top, window[-m][node] + self._lookup(part), out=top)
            owner = np.zeros(n, np.int64)
            owner[node] = np.arange(len(node))
            np.maximum.accumulate(owner, out=owner)
            score = top[owner] if len(node) else window[-1]
            ended = np.flatnonzero(size == d)
            counts[ended] = -score[ended] & (UNIT - 1)
            window = [*window, score][-self.longest:]
            hashes = [*hashes, full][-self.longest:]
        out = np.zeros(n, np.int64)
        out[order] = counts
        return out

    def count(self, tokens: pa.Array) -> np.ndarray:
        """Pieces of each distinct pre-token (without its start mark)."""
        marked = [WORD_START + t if t else "" for t in tokens.to_pylist()]
        out = np.zeros(len(marked), np.int64)
        short = [i for i, t in enumerate(marked) if len(t) <= TRIE_CHARS]
        if short:
            out[short] = self.trie([marked[i] for i in short])
        for i, t in enumerate(marked):
            if len(t) > TRIE_CHARS:
                out[i] = self.one(t)
        return out


def count_tokens(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None) -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` of every whole text (NULL: empty, no
    tokens). Pre-tokens are runs without ASCII white space. Row by row, no
    shuffle; a task holds the trie of one batch at a time. ``vocabulary``: path
    of a sentencepiece model whose pieces are used."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(Vocabulary.of_model(vocabulary))
        for batch in bounded(batches, "text"):
            texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            parts = pc.ascii_split_whitespace(texts)
            coded = parts.values.dictionary_encode()
            offsets = parts.offsets.to_numpy()
            at = coded.indices.to_numpy()
            pieces = counter.count(coded.dictionary)[at]
            words = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False).astype(np.int64)[at]
            total = [np.concatenate([[0], np.cumsum(x)])[offsets - offsets[0]] for x in (words, pieces)]
            yield table_of(doc_id=batch.column("doc_id"), n_pretokens=pa.array(np.diff(total[0])),
                           n_tokens=pa.array(np.diff(total[1])))

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
