"""Language identification by cross-parsing against suffix automata.

For every language a suffix automaton is built of a sample of labelled text.
A text is parsed from left to right into the longest phrases that occur in
the sample (an unknown character is a phrase of its own); the language with
the cheapest phrases wins. A phrase costs ``log2`` of its sample's length, a
character that a language does not know ``log2`` of the longest sample's in
every language, so a small sample gains nothing by what it lacks.

Texts are lower-cased, letters outside the samples become one unknown letter,
and runs of other characters become one blank. Long texts are parsed in many
lanes of ``block_chars`` characters at once, one array look-up per character.
A lane begins at the automaton's start; the phrase that runs into it from the
lane before is then followed until both parses meet in one state, which they
do after some phrases, and the lane's count is put right by the difference. So
the count is that of one parse of the whole text, whatever its length.

Every letter of the samples counts: a language's most frequent letters have a
column in its table, the others' transitions (in all a few times the sample)
are sorted and searched.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, free_name

UNDETERMINED = "und"
BLANK, UNKNOWN = 0, 1


def letter_table(letters: str) -> np.ndarray:
    """Class of every code point: 0 for what is no letter, 1 for letters
    outside ``letters``, else a class for each letter (either case)."""
    known = {c: i + 2 for i, c in enumerate(letters)}
    table = np.zeros(0x110000, np.min_scalar_type(len(letters) + 2))
    for code in range(0x110000):
        c = chr(code)
        if unicodedata.category(c)[0] == "L":
            table[code] = known.get(c.lower()[0], UNKNOWN)
    return table


def classes_of(text: str, table: np.ndarray) -> np.ndarray:
    """The text's letter classes, runs of blanks as one, none at the ends."""
    raw = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = (raw > 0) | np.r_[False, raw[:-1] > 0][: len(raw)]
    out = raw[keep]
    return out[:-1] if len(out) and out[-1] == BLANK else out


def transitions(symbols: np.ndarray) -> list[dict[int, int]]:
    """Next state by symbol, for each state (0 is the start) of the automaton
    that accepts every substring of ``symbols``."""
    to: list[dict[int, int]] = [{}]
    longest, link = [0], [-1]
    last = 0
    for c in symbols.tolist():
        cur = len(to)
        to.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in to[p]:
            to[p][c] = cur
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if longest[p] + 1 == longest[q]:
                link[cur] = q
            else:
                twin = len(to)
                to.append(to[q].copy())
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return to


def _fair_phrase(symbols: np.ndarray) -> float:
    """Least mean phrase length that speaks for a language: the last quarter of
    its sample is parsed against the rest, and half way (by ratio) from there
    to 1, where no phrase is known, lies the bound."""
    cut = len(symbols) * 3 // 4
    edges, held = transitions(symbols[:cut]), symbols[cut:].tolist()
    state = count = 0
    for c in held:
        if c in edges[state]:
            state = edges[state][c]
            continue
        count += state != 0
        state = edges[0].get(c, 0)
        count += state == 0
    count += state != 0
    return float(np.sqrt(len(held) / count)) if count else 1.0


@dataclass(frozen=True)
class Automaton:
    """One language's automaton. ``columns`` gives each letter class its
    column: 0 the blank, 1 what the sample lacks, then its letters. A state's
    offset is its number times ``width``; ``steps[offset + column]`` holds the
    next offset times 4 plus the phrases that end (0 to 2). Columns from
    ``width`` on are not in that table: ``keys`` are their transitions (state
    and column in one number, sorted), ``found`` the steps, ``missed`` the
    steps of all other states. ``fair``: its bound of :func:`speaks`."""

    columns: np.ndarray
    width: int
    steps: np.ndarray
    price: float
    fair: float
    keys: np.ndarray
    found: np.ndarray
    missed: np.ndarray

    @classmethod
    def build(cls, symbols: np.ndarray, classes: int, table_letters: int) -> Automaton:
        """Of a sample given as classes; ``table_letters`` letters have a
        column of the table."""
        often = np.bincount(symbols, minlength=classes)
        often[[BLANK, UNKNOWN]] = 0
        own = np.argsort(-often, kind="stable")[: np.count_nonzero(often)]
        columns = np.full(classes, UNKNOWN, np.int32)
        columns[BLANK] = BLANK
        columns[own] = np.arange(2, len(own) + 2)
        width, rare = min(len(own), table_letters) + 2, max(len(own) - table_letters, 0)
        edges = transitions(columns[symbols])
        first = np.full(width, -1, np.int64)
        for c, target in edges[0].items():
            if c < width:
                first[c] = target
        kind = np.int32 if len(edges) * width * 4 < 1 << 31 else np.int64
        steps = np.empty((len(edges), width), kind)
        steps[:] = np.where(first >= 0, (first * width << 2) + 1, 2)
        steps[0, first < 0] = 1
        keys, found, missed = [], [], np.full(rare, 2, np.int64)
        for state, out in enumerate(edges):
            for c, target in out.items():
                if c < width:
                    steps[state, c] = target * width << 2
                    continue
                keys.append(state * rare + c - width)
                found.append(target * width << 2)
                if not state:
                    missed[c - width] = found[-1] + 1
        order = np.argsort(np.asarray(keys, np.int64))
        return cls(columns, width, steps.ravel(), float(np.log2(max(len(symbols), 2))), _fair_phrase(columns[symbols]),
                   np.asarray(keys, np.int64)[order], np.asarray(found, np.int64)[order], missed)

    def step(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Next offsets times 4 plus the phrases that end."""
        if not len(self.keys):
            return self.steps[state + column]
        got = self.steps[state + np.where(column < self.width, column, BLANK)]
        at = np.flatnonzero(column >= self.width)
        if len(at):
            rare, own = column[at].astype(np.int64) - self.width, state[at].astype(np.int64)
            want = own // self.width * len(self.missed) + rare
            place = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            got[at] = np.where(self.keys[place] == want, self.found[place], self.missed[rare] - (own == 0))
        return got

    def _lanes(self, columns: np.ndarray, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that end in each lane, and the state at its end."""
        order = np.argsort(-length, kind="stable")
        at, length = at[order], length[order]
        state, count = np.zeros(len(at), self.steps.dtype), np.zeros(len(at), np.int32)
        active = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1), side="right") if len(at) else at
        for t, k in enumerate(active.tolist()):
            got = self.step(state[:k], columns[at[:k] + t])
            count[:k] += got & 3
            np.right_shift(got, 2, out=state[:k])
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return count[back], state[back]

    def _follow(self, columns: np.ndarray, at: np.ndarray, length: np.ndarray, state: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A parse that comes into each lane in ``state`` beside the one that
        begins there, until they meet: by how many more phrases end, whether
        they met, and where not, the state at the end."""
        more, met, last = np.zeros(len(at), np.int64), state == 0, state.copy()
        live = np.flatnonzero(~met)
        own = np.zeros(len(live), self.steps.dtype)
        came = state[live]
        t = 0
        while len(live):
            c = columns[at[live] + t]
            one, two = self.step(came, c), self.step(own, c)
            more[live] += (one & 3).astype(np.int64) - (two & 3)
            came, own, t = one >> 2, two >> 2, t + 1
            same, over = came == own, length[live] == t
            met[live[same]] = True
            last[live[over & ~same]] = came[over & ~same]
            stay = ~same & ~over
            live, came, own = live[stay], came[stay], own[stay]
        return more, met, last

    def phrases(self, codes: np.ndarray, offsets: np.ndarray, block_chars: int) -> np.ndarray:
        """Phrases of texts given as classes."""
        columns = self.columns[codes]
        sizes = np.diff(offsets)
        blocks = -(-sizes // block_chars)
        owner = np.repeat(np.arange(len(sizes)), blocks)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        at = offsets[owner] + number * block_chars
        length = np.minimum(sizes[owner] - number * block_chars, block_chars)
        count, end = self._lanes(columns, at, length)
        count = count.astype(np.int64)
        added, into = np.zeros(len(at), np.int64), np.flatnonzero(number > 0)
        true_end = end.copy()
        while len(into):  # lanes whose way in is not yet followed, or has changed
            more, met, last = self._follow(columns, at[into], length[into], true_end[into - 1])
            added[into] = more
            now = np.where(met, end[into], last)
            after = into[now != true_end[into]] + 1
            true_end[into] = now
            after = after[after < len(at)]
            into = after[number[after] > 0]
        tail = np.flatnonzero(np.r_[number[1:] == 0, True]) if len(at) else into
        count += added
        count[tail] += true_end[tail] != 0
        return np.bincount(owner, count, minlength=len(sizes)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    """The automata of all languages over the ``letters`` of all samples."""

    languages: tuple[str, ...]
    letters: str
    automata: tuple[Automaton, ...]
    block_chars: int

    @classmethod
    def build(cls, samples: dict[str, list[str]], sample_chars: int, block_chars: int = 2048,
              table_letters: int = 120) -> LanguageModel:
        """``samples``: texts by language; of each language ``sample_chars``
        characters are used. Languages are built one at a time."""
        names = tuple(sorted(samples))
        letters = "".join(sorted({c for t in samples.values() for x in t for c in x.lower() if unicodedata.category(c)[0] == "L"}))
        table = letter_table(letters)
        automata = []
        for name in names:
            joined = [np.r_[classes_of(t, table), BLANK] for t in samples[name]]
            symbols = np.concatenate(joined)[:sample_chars].astype(np.int64) if joined else np.zeros(0, np.int64)
            automata.append(Automaton.build(symbols, len(letters) + 2, table_letters))
        return cls(names, letters, tuple(automata), block_chars)

    @property
    def fair(self) -> dict[str, float]:
        return {n: a.fair for n, a in zip(self.languages, self.automata)}

    def phrases(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases (texts by languages) of texts given as classes."""
        if not self.automata:
            return np.zeros((len(offsets) - 1, 0), np.int64)
        return np.stack([a.phrases(codes, offsets, self.block_chars) for a in self.automata], 1)

    def costs(self, codes: np.ndarray, offsets: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Prices (texts by languages) of parses with ``count`` phrases;
        characters unknown to a language count among them."""
        prices = np.asarray([a.price for a in self.automata])
        cost = count * prices
        for i, a in enumerate(self.automata):
            at = np.flatnonzero(a.columns[codes] == UNKNOWN)
            unknown = np.bincount(np.searchsorted(offsets, at, side="right") - 1, minlength=len(count))
            cost[:, i] += unknown * (prices.max() - a.price)
        return cost


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_rows: int = 64, row_chars: int = 500, total_rows: int = 1024, block_chars: int = 2048) -> LanguageModel:
    """Learn from ``docs`` (rows to learn from) with a non-NULL language and
    text: of each language the ``sample_rows`` rows lowest by a hash of their
    id, and of each a window of ``row_chars`` characters at a place drawn by a
    hash from the whole text. With many languages a language has fewer rows, so
    that all have about ``total_rows``, but one at least. Each task sends that
    many rows of a language at most. A model without languages calls
    everything ``und``."""
    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`").cast("string").alias("lang")
    known = docs.where(lang.isNotNull() & (F.length(text) > 0))
    languages = known.select(lang).distinct().count()
    share = max(1, min(sample_rows, total_rows // max(languages, 1)))
    at = F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.lit("window")), F.greatest(F.length(text) - row_chars, F.lit(0)) + 1)
    rows = known.select(lang, text.substr((at + 1).cast("int"), F.lit(row_chars)).alias("text"), F.xxhash64(F.col(f"`{id_col}`")).alias("h"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    picked = rows.withColumn("place", place).where(F.col("place") <= share).collect()
    samples: dict[str, list[str]] = {}
    for r in sorted(picked, key=lambda r: r["place"]):
        samples.setdefault(r["lang"], []).append(r["text"])
    return LanguageModel.build(samples, sample_rows * row_chars, block_chars)


class Predictor:
    def __init__(self, model: LanguageModel):
        self.model = model
        self.table = letter_table(model.letters)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, mean phrase length and parsed length of every text."""
        m = self.model
        coded = [classes_of(t or "", self.table) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded])])
        sizes = np.diff(offsets)
        codes = np.concatenate(coded) if coded else np.zeros(0, np.uint8)
        count = m.phrases(codes, offsets)
        names = np.full(len(texts), UNDETERMINED, object)
        score, mean = np.zeros(len(texts)), np.zeros(len(texts))
        some = sizes > 0  # a letter, known or not
        if len(m.languages) and some.any():
            cost = m.costs(codes, offsets, count)[some]
            best = cost.argmin(1)
            names[some] = np.asarray(m.languages, object)[best]
            low = np.partition(cost, min(1, cost.shape[1] - 1), axis=1)
            score[some] = 1 - low[:, 0] / low[:, 1] if cost.shape[1] > 1 else 1.0
            mean[some] = sizes[some] / count[some, best]
        return names.tolist(), score, mean, sizes


def speaks(into: str = "language", min_phrase: float | None = None, min_letters: int = 20):
    """Condition on :func:`predict`'s struct: a language was found and, for
    texts long enough to tell, its phrases are as long as held-back text of
    that language lets expect (``fair_phrase``; ``min_phrase`` if given)."""
    got = F.col(f"`{into}`")
    least = got["fair_phrase"] if min_phrase is None else F.lit(min_phrase)
    return (got["lang_pred"] != UNDETERMINED) & ((got["letters"] < min_letters) | (got["phrase_chars"] >= least))


def predict(docs: DataFrame, model: LanguageModel, *, text_col: str = "text", into: str | None = None) -> DataFrame:
    """``docs`` with one more column ``into``, a struct: ``lang_pred``
    (the first by code point on ties; ``und`` if the text is NULL or has no
    letter), ``score`` (0 to 1: how much cheaper the best parse is than the
    second best), ``phrase_chars`` (mean phrase length of the best parse),
    ``letters`` (letters and blanks between words that were parsed) and
    ``fair_phrase`` (the language's bound of :func:`speaks`, 0 for ``und``).
    Row by row, whole texts, no shuffle; other columns are carried along.
    ``into`` is ``language`` unless given, with underscores added where docs
    has such a column. The model goes to the tasks as a broadcast of bounded
    size (:func:`fit`'s sample, some 120 numbers for each of its characters)."""
    into = into or free_name(docs.columns, "language")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    made = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                         T.StructField("phrase_chars", T.DoubleType()), T.StructField("letters", T.LongType()),
                         T.StructField("fair_phrase", T.DoubleType())])

    fair = model.fair

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = None
        for batch in bounded(batches, text_col):
            predictor = predictor or Predictor(sent.value)
            names, score, mean, letters = predictor.predict(batch.column(text_col).to_pylist())
            new = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score), pa.array(mean),
                                              pa.array(letters), pa.array([fair.get(x, 0.0) for x in names], pa.float64())], made.names)
            yield pa.record_batch([*batch.columns, new], [*batch.schema.names, into])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(into, made)]))
