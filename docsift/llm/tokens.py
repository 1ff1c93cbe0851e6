"""Token ids of whole texts by a public tokenizer file of the ``tokenizers``
library, with a bounded per-process cache of white-space separated chunks.

A chunk's ids do not depend on its neighbours for tokenizers that drop white
space (:func:`splits_on_space` checks the file): normalisation never composes
across ASCII white space and the pre-tokenizer always cuts there. So each
distinct chunk is encoded by the library once and whole texts are put
together by numpy gathers. Other tokenizer files are encoded text by text.
"""

from __future__ import annotations

import itertools
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct chunks kept by one Python worker, and the longest chunk kept.
CACHE_CHUNKS = 400_000
CACHE_CHUNK_BYTES = 64


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def splits_on_space(path: str) -> bool:
    """True if the file's pre-tokenizer removes what its pattern leaves out
    and the pattern never takes white space."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f).get("pre_tokenizer") or {}
    first = (spec.get("pretokenizers") or [spec])[0]
    return (first.get("type") == "Split" and first.get("behavior") == "Removed"
            and bool(first.get("invert")) and "[^\\s" in first.get("pattern", {}).get("Regex", ""))


#: Chunks encoded as one text.
JOINED = 400

#: Composed Latin letters: they stay letters when normalised and lower-cased.
LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]"
MARK = "[.,;:!?]"


class Encoder:
    """``encode(texts)`` gives flat ids and per-text offsets."""

    _made: dict[str, Encoder] = {}

    @classmethod
    def of(cls, path: str | None = None) -> Encoder:
        """The encoder of this process for a tokenizer file."""
        path = path or default_path()
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_chunk = splits_on_space(path)
        self.cache_chunks = cache_chunks
        self.vocab_size = self.tokenizer.get_vocab_size()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        #: ids that end a pre-token, if the file marks them
        self.last_id = np.zeros(self.vocab_size, bool) if suffix else None
        if suffix:
            self.last_id[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.hits = np.zeros(1 << 14, np.int32)
        self.n_slots = self.n_ids = 0

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        if n <= len(a):
            return a
        out = np.zeros(max(n, 2 * len(a)), a.dtype)
        out[: len(a)] = a
        return out

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and sizes as the library gives them."""
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(itertools.chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks that are one pre-token each, encoded many at a time, as one
        text with blanks between them, and told apart by the ids that end a
        pre-token; if those do not add up, one by one."""
        ids, _ = self._library([" ".join(words[i: i + JOINED]) for i in range(0, len(words), JOINED)])
        ends = np.flatnonzero(self.last_id[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(words) else self._library(words)

    def _add(self, chunks: list[str], words: bool) -> None:
        if not chunks:
            return
        ids, sizes = self._encode_words(chunks) if words else self._library(chunks)
        n, m = self.n_slots + len(sizes), self.n_ids + len(ids)
        self.flat, self.start, self.size, self.hits = (
            self._room(self.flat, m), self._room(self.start, n), self._room(self.size, n), self._room(self.hits, n))
        self.flat[self.n_ids: m] = ids
        self.size[self.n_slots: n] = sizes
        self.start[self.n_slots: n] = self.n_ids + np.cumsum(sizes) - sizes
        self.hits[self.n_slots: n] = 0
        self.n_slots, self.n_ids = n, m

    def _make_room(self) -> None:
        """Forget the chunks seen in one batch only (all, if most were seen
        again)."""
        kept = [(c, i) for c, i in self.slots.items() if self.hits[i] > 1]
        flat, start, size = self.flat, self.start, self.size
        self._clear()
        if 2 * len(kept) > self.cache_chunks or not kept:
            return
        at = np.asarray([i for _, i in kept])
        sizes = size[at]
        ends = np.cumsum(sizes)
        ids = flat[np.repeat(start[at] - (ends - sizes), sizes) + np.arange(ends[-1])]
        self.slots = {c: i for i, (c, _) in enumerate(kept)}
        self.n_slots, self.n_ids = len(kept), len(ids)
        self.flat, self.size, self.start = ids, sizes, ends - sizes
        self.hits = np.zeros(len(kept), np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint32) of all texts one after another, and the offsets of
        each text (one more than texts). NULL counts as the empty text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_chunk:
            ids, sizes = self._library(texts.to_pylist())
            return ids, np.concatenate([[0], np.cumsum(sizes)])
        if self.last_id is not None:
            # the pre-tokenizer cuts between a letter and a mark anyway
            texts = pc.replace_substring_regex(texts, f"({LETTER})({MARK})", r"\1 \2")
        parts = pc.ascii_split_whitespace(texts)
        offsets = parts.offsets.to_numpy()
        coded = parts.values.dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        if len(self.slots) + len(chunks) > self.cache_chunks:
            self._make_room()
        known, base = self.slots, self.n_slots
        slot = np.fromiter((known.get(c, -1) for c in chunks), np.int64, len(chunks))
        new = np.flatnonzero(slot < 0)
        fresh = coded.dictionary.take(pa.array(new))
        long = pc.greater(pc.binary_length(fresh), CACHE_CHUNK_BYTES).to_numpy(zero_copy_only=False)
        word = np.zeros(len(new), bool)
        if self.last_id is not None:
            word = pc.match_substring_regex(fresh, f"^(?:{LETTER}+|{MARK}+)$").to_numpy(zero_copy_only=False) & ~long
        groups = [[chunks[i] for i in new[own].tolist()] for own in (word, ~word & ~long, long)]
        slot[np.concatenate([new[word], new[~word & ~long], new[long]])] = np.arange(base, base + len(new))
        self._add(groups[0], True)
        self._add(groups[1], False)
        known.update(zip(groups[0] + groups[1], range(base, base + len(new))))
        keep = self.n_slots, self.n_ids
        self._add(groups[2], False)
        self.hits[slot] += 1
        at = slot[coded.indices.to_numpy()]
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.start[at] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        self.n_slots, self.n_ids = keep  # long chunks are not kept
        return ids, np.concatenate([[0], ends])[offsets - offsets[0]]
