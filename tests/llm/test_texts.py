"""Operators on single texts against brute-force versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from docsift.llm import fingerprint, langid, quality, queries, tokencount, toxicity

SF, SF_MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = ["language", "quality", "mix", "mix_of", "set_key", "id", "class", "size", "source_size", "n", "h", "g", "hit", "lang_pred"]


@pytest.fixture(scope="module")
def hard(spark):
    """NULLs in every column, empty, blank and long texts, ties, repeated
    rows, and extra columns with the operators' own names."""
    texts = [None, "", " \t\n\x0b\x0c\r", "a b c a b c d", "x", "1234 !!", "line\nline\n\n \nline", "ça va",
             "w " * 60, "the of and " * 40 + "end", "z" * 200_000, "one two three four five six seven " * 3000]
    rows = [(i if i != 5 else None, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", None)
            for i, t in enumerate(texts)] + [(3, "a b c a b c d", "en", "s0", None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASH})


def _table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---------------------------------------------------------------- quality

def _signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def _long_hash(values, seed=42):
    """Spark's hash of 64-bit numbers, chained over columns."""
    for v in values:
        seed = xxhash.xxh64_intdigest(int(v).to_bytes(8, "little", signed=True), seed=seed)
    return _signed(seed)


def _base(text):
    words = WORD.findall(text or "")
    where = Counter(tuple(words[i: i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if where[tuple(words[i: i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered))


def _grams(text, buckets):
    h = [_signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in WORD.findall(text or "")]
    return [x % buckets for x in h] + [_long_hash(p) % buckets for p in zip(h, h[1:])]


def _quality(docs, trusted, buckets, threshold=-0.2):
    first = {}
    for k, t in docs:
        if t is not None:
            first[t] = min((k for k in (first.get(t), k) if k is not None), default=None)
    hit = {t for k, t in docs if k is not None and k in trusted}
    raw, target = Counter(), Counter()
    for k, t in docs:
        if t is not None and first[t] == k:
            raw.update(g := _grams(t, buckets))
            if t in hit:
                target.update(g)
    nr, nt = raw.total(), target.total()
    out = []
    for k, t in docs:
        g = _grams(t, buckets)
        ratio = 0.0
        for x in g if nt else ():
            mean = nt * max(raw[x] - 1, 0) / max(nr - 1, 1)
            ratio += (math.log((target[x] + 1) / (mean + 1)) + mean / (2 * (mean + 1) ** 2)) / len(g)
        b = _base(t)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        out.append((k, *b, failed, not failed and ratio >= threshold, ratio))
    return out


def _power_of_two(texts):
    """Buckets for a target of these texts: some eight grams in each."""
    size = max(sum(len(t.encode()) for t in set(texts)) // 24, 1)
    return min(max(1 << (size - 1).bit_length(), 1 << 10), 1 << 17)


def test_op2_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in _table(spark, SF, "documents").collect()]
    trusted = {r.doc_id for r in _table(spark, SF, "labels").collect() if r.quality == 1}
    got = {r.doc_id: r for r in queries.QUERIES["op2_quality_rules"](spark, SF).collect()}
    buckets = _power_of_two(t for k, t in docs if k in trusted)
    for k, *base, failed, kept, ratio in _quality(docs, trusted, buckets):
        r = got[k]
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed] == [*base, failed]
        assert abs(r.ratio - ratio) < 1e-9 and r.kept == kept


def test_quality_of_hard_rows(spark, hard):
    hard = hard.withColumn("ratios", F.lit("own"))
    trusted = spark.createDataFrame([(11, "x"), (11, "y"), (None, "z")], "doc_id long, text string")
    model = quality.fit(hard, trusted, min_buckets=64, max_buckets=64)
    got = quality.score(hard, model)
    assert got.columns == [*hard.columns, "quality_"]
    docs = [(r.doc_id, r.text) for r in hard.collect()]
    want = _quality(docs, {11}, 64)
    rows = [(r.doc_id, *(r.quality_[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")), round(r.quality_.ratio, 9)) for r in got.collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(rows, key=key) == sorted([(*w[:8], round(w[8], 9)) for w in want], key=key)
    assert quality.score(hard.limit(0), model).count() == 0
    none = quality.fit(hard.limit(0), trusted)
    assert none.buckets == 1 << 10 and none.table.first()["ratios"] == [0.0] * (1 << 10)


def test_one_threshold_serves_every_size(spark):
    """Documents like the trusted ones stay and junk goes, whatever the size."""
    rng = np.random.default_rng(7)
    good, junk = [f"w{i}" for i in range(200)], [f"j{i}" for i in range(30)]
    for many in (160, 1600):
        rows = [(i, " ".join(rng.choice(junk if i % 8 == 0 else good, 120))) for i in range(many)]
        docs = spark.createDataFrame(rows + [(many + i, rows[9][1]) for i in range(30)], "doc_id long, text string")
        trusted = docs.where("doc_id % 8 in (2, 3) and doc_id < " + str(many))
        got = quality.score(docs, quality.fit(docs, trusted)).collect()
        wrong = [(r.doc_id, r.quality.ratio) for r in got if r.quality.kept != (r.doc_id >= many or r.doc_id % 8 != 0)]
        assert not wrong


def test_quality_is_native(spark):
    docs = _table(spark, SF, "documents")
    plan = quality.score(docs, quality.fit(docs, _table(spark, SF, "labels")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_quality_drops_junk_and_keeps_clean(spark):
    r = queries.QUERIES["op2_quality_rules"](spark, SF_MORE).join(_table(spark, SF_MORE, "labels"), "doc_id")
    rate = {x.quality: x.kept for x in r.where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rate[1] > 0.99 and rate[0] < 0.2


# ---------------------------------------------------------------- languages

def _cross_parse(text, samples, table):
    """Phrases of a whole text by plain substring search."""
    mark = lambda x: "".join(map(chr, x + 65))
    codes = mark(langid.classes_of(text, table))
    out = []
    for sample in samples:
        count = at = 0
        while at < len(codes):
            n = 0
            while at + n < len(codes) and codes[at + n] != mark(np.asarray([langid.UNKNOWN])) and codes[at: at + n + 1] in sample:
                n += 1
            at += max(n, 1)
            count += 1
        out.append(count)
    return out


@pytest.mark.parametrize("block", [3, 17, 100, 5000])
def test_phrases_equal_substring_search(spark, block):
    """Lanes are put together to one parse, also where a phrase is longer than a lane."""
    docs = _table(spark, SF, "documents").where("lang is not null").collect()
    samples = {}
    for r in docs[:40]:
        samples.setdefault(r.lang, []).append(r.text[:300])
    model = langid.LanguageModel.build(samples, 1000, block_chars=block)
    table = langid.letter_table(model.letters)
    plain = ["".join(map(chr, np.concatenate([np.r_[langid.classes_of(t, table), 0] for t in samples[k]])[:1000] + 65)) for k in model.languages]
    texts = [r.text[:700] for r in docs[40:70]] + ["", "日本語 Ünß", "1 2 3", "a", "É" * 250]
    texts += [t for x in samples.values() for t in x[:2]]  # one phrase as long as the text
    coded = [langid.classes_of(t, table) for t in texts]
    off = np.concatenate([[0], np.cumsum([len(c) for c in coded])])
    got = model.phrases(np.concatenate(coded), off)
    assert got.tolist() == [_cross_parse(t, plain, table) for t in texts]


def test_suffix_automaton_accepts_exactly_the_substrings():
    rng = np.random.default_rng(3)
    s = rng.integers(0, 3, 60)
    to = langid.transitions(s)
    text = "".join(map(str, s))
    for _ in range(500):
        w = "".join(map(str, rng.integers(0, 3, rng.integers(1, 8))))
        state = 0
        for c in w:
            state = to[state].get(int(c), -1) if state >= 0 else -1
        assert (state >= 0) == (w in text)


def _made_up(rng, first, letters, words=1500):
    """Texts of two-letter words over letters from ``first`` on, some words
    more frequent than others."""
    lexicon = ["".join(map(chr, first + rng.integers(0, letters, 2))) for _ in range(words)]
    share = 1 / np.arange(1, words + 1)
    return lambda n: "".join(rng.choice(lexicon, n, p=share / share.sum()))


def test_every_letter_of_the_samples_is_known(spark):
    """Scripts of thousands of letters beside one of few."""
    rng = np.random.default_rng(2)
    text = {"l1": _made_up(rng, 0x4E00, 3000), "l2": _made_up(rng, 0x7000, 2500), "l3": _made_up(rng, 0x61, 26)}
    rows = [(i, k, text[k](150)) for i, k in enumerate(list(text) * 40)]
    schema = "doc_id long, lang string, text string"
    model = langid.fit(spark.createDataFrame(rows, schema))
    assert set(model.letters) == {c for _, _, t in rows for c in t}
    fresh = [(i, k, text[k](100)) for i, k in enumerate(list(text) * 10)] + [(99, "l4", "".join(map(chr, range(0xAC00, 0xAC64))))]
    got = langid.predict(spark.createDataFrame(fresh, schema), model).withColumn("ok", langid.speaks()).collect()
    assert all((r.lang == r.language.lang_pred and r.ok) if r.lang != "l4" else not r.ok for r in got)


def test_letters_without_a_column_are_parsed_alike(spark):
    docs = _table(spark, SF, "documents").where("lang is not null").limit(60).collect()
    samples = {}
    for r in docs[:30]:
        samples.setdefault(r.lang, []).append(r.text[:300])
    texts = [r.text[:700] for r in docs[30:]] + ["", "日本語 Ünß", "a"]
    got = []
    for k in (120, 20, 5, 0):
        model = langid.LanguageModel.build(samples, 1000, 100, k)
        coded = [langid.classes_of(t, langid.letter_table(model.letters)) for t in texts]
        got.append(model.phrases(np.concatenate(coded), np.cumsum([0, *map(len, coded)])).tolist())
    assert got[1:] == got[:1] * 3


def test_a_long_text_is_parsed_as_one(spark):
    """Fifty times the same text has some fifty times its phrases."""
    docs = [r.text for r in _table(spark, SF, "documents").where("lang = 'en' and length(text) > 500").limit(20).collect()]
    model = langid.LanguageModel.build({"en": docs[:10], "xx": ["zz zz"]}, 5000, 64)
    predictor = langid.Predictor(model)
    _, _, short, _ = predictor.predict([docs[12]])
    _, _, long, size = predictor.predict([" ".join([docs[12]] * 50)])
    assert abs(short[0] - long[0]) < 0.05 and size[0] > 49 * len(docs[12]) * 0.8


def test_many_languages_share_the_sample(spark):
    """Hundreds of languages: fewer rows each, a model of bounded size."""
    rows = [(i, f"l{i % 300}", chr(0x4E00 + 7 * (i % 300)) * 3 + f" word{i % 300} text") for i in range(1200)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, lang string, text string"), total_rows=600)
    assert len(model.languages) == 300 and sum(a.steps.nbytes for a in model.automata) < 20 << 20
    names = langid.Predictor(model).predict([t for _, _, t in rows[:300]])[0]
    assert names == [k for _, k, _ in rows[:300]]


@pytest.mark.parametrize("row", ["ok", "a", "no way", "the end of it all"])
def test_a_language_of_one_short_row_wins_nothing_else(spark, row):
    docs = _table(spark, SF, "documents").where("lang is not null and length(text) > 200").limit(200).collect()
    samples = {}
    for r in docs[:160]:
        samples.setdefault(r.lang, []).append(r.text[:500])
    predictor = langid.Predictor(langid.LanguageModel.build({**samples, "tiny": [row]}, 32_000))
    names, _, mean, _ = predictor.predict([r.text for r in docs[160:]] + [row])
    assert names == [r.lang for r in docs[160:]] + ["tiny"] and mean[:-1].min() > 2


def test_a_smaller_sample_still_wins_its_own_texts(spark):
    docs = _table(spark, SF, "documents").where("lang is not null and length(text) > 200").limit(200).collect()
    samples = {}
    for r in docs[:160]:
        samples.setdefault(r.lang, []).append(r.text[:500])
    for small in samples:
        model = langid.LanguageModel.build({k: v if k != small else [v[0]] for k, v in samples.items()}, 32_000)
        assert langid.Predictor(model).predict([r.text for r in docs[160:]])[0] == [r.lang for r in docs[160:]]


def test_op4_held_out_accuracy(spark):
    got = queries.QUERIES["op4_language_id"](spark, SF_MORE).join(_table(spark, SF_MORE, "documents").select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98


def test_languages_of_hard_rows(spark, hard):
    model = langid.fit(hard)
    got = langid.predict(hard, model).orderBy("doc_id").collect()
    assert len(got) == hard.count() and got[0].asDict()["language"] == "own language"
    by = {r.text: r["language_"] for r in got}
    for t in (None, "", " \t\n\x0b\x0c\r", "1234 !!"):
        assert by[t].lang_pred == "und" and by[t].score == 0
    assert by["ça va"].lang_pred == "en"
    empty = langid.fit(hard.limit(0))
    assert {r["language_"].lang_pred for r in langid.predict(hard, empty).collect()} == {"und"}
    assert langid.predict(hard.limit(0), model).count() == 0
    assert hard.count() > langid.predict(hard, model, into="l").where(langid.speaks("l")).count() > 5


# ---------------------------------------------------------------- toxicity

def test_op6_held_out(spark):
    sf = "/root/testdata/sf0.1"  # fewer tables hold too few toxic texts to learn from
    got = queries.QUERIES["op6_toxicity"](spark, sf).join(_table(spark, sf, "labels"), "doc_id", "left").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.toxic is not None and r.held_out]
    hits = sum(r.predicted and r.toxic for r in held)
    assert hits / sum(r.toxic for r in held) > 0.8 and hits / sum(r.predicted for r in held) > 0.8


def test_misspellings_share_subwords():
    clean = [f"kind words of day {i} and more text here" for i in range(60)]
    bad = [f"you awful scoundrel of day {i} go away" for i in range(60)]
    model = toxicity.train(clean + bad, np.repeat([0, 1], 60), np.ones(120), steps=40)
    s = model.score(pa.array(["such scoundrels here", "a kind day", "SCOUNDRELL!", None, "", "日本"]))
    assert s[0] > 0.5 > s[1] and s[2] > 0.5 and ((s >= 0) & (s <= 1)).all() and s[3] == s[4]


def test_scores_equal_plain_sums():
    model = toxicity.ToxicityModel(np.random.default_rng(1).normal(0, 30, 1 << 10).astype(np.float32), -1.0, 60)
    texts = ["Bad, bad words!", "a", "", None, "x " * 500, "É ü ß", "long" * 5000]
    got = model.score(pa.array(texts))
    for t, s in zip(texts, got):
        words = Counter(w.strip(".,;:!?\"'()[]|*#&%$-") for w in (t or "").lower().split())
        total, n = 0.0, 60.0
        for w, k in words.items():
            g, _ = toxicity.subwords(pa.array([w]), 1 << 10)
            total += k ** 0.5 * model.weights[g].astype(float).sum()
            n += k ** 0.5 * len(g)
        assert abs(s - 1 / (1 + math.exp(-np.clip(-1 + total / n, -40, 40)))) < 1e-6


def test_toxicity_of_hard_rows(spark, hard):
    labels = spark.createDataFrame([(9, 1), (9, 0), (8, 0), (11, 0), (None, 1), (3, None), (77, 1)], "doc_id long, toxic int")
    got = toxicity.score(hard, toxicity.fit(hard, labels, steps=3)).collect()
    assert len(got) == hard.count() and all(0 <= r.score <= 1 for r in got)
    one = toxicity.fit(hard, labels.limit(0))
    assert {r.score for r in toxicity.score(hard, one).collect()} == {0.5}
    assert toxicity.score(hard.limit(0), one).count() == 0


def test_long_texts_are_learned_from(spark):
    """Every text of label 1 is long; its word is all over it."""
    long = lambda i: " ".join(f"word{(i * j) % 97}" + (" scoundrel" if j % 9 == 0 else "") for j in range(900))
    rows = [(i, long(i) if i % 2 else f"kind words of day {i} and word{i % 97}", i % 2) for i in range(1, 81)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, docs.select("doc_id", "toxic"), steps=40)
    s = model.score(pa.array(["you scoundrels " * 3, "a kind day", rows[0][1]]))
    assert s[0] > s[1] + 0.3 and s[2] > 0.5


def test_rows_to_learn_from_are_the_first_of_each_task(spark):
    known = spark.range(0, 3000, 1, 8).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    got = toxicity._lowest(known, (40, 25))
    rows = known.withColumn("h", F.xxhash64("id")).orderBy("h", "id").collect()
    want = {r.id for y, n in ((0, 40), (1, 25)) for r in [r for r in rows if r.y == y][:n]}
    assert {r.id for r in got.collect()} == want and got.count() == 65
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TakeOrderedAndProject") == 2 and "Window" not in plan and "hashpartitioning" not in plan


def test_a_long_text_is_sampled_all_over(spark):
    text = " ".join(f"w{i}" for i in range(20_000))
    df = spark.createDataFrame([(1, text), (2, "z" * 200_000), (3, "short  text\n")], "id long, text string")
    got = [r[0] for r in df.orderBy("id").select(toxicity._shortened(F.col("id"), F.col("text"), 3000)).collect()]
    at = [int(w[1:]) for w in got[0].split()]
    assert 1500 < len(got[0]) < 4500 and at == sorted(at) and min(at) < 2000 and max(at) > 18_000
    assert 0 < len(got[1]) < 6000 and got[2] == "short  text\n"


# ---------------------------------------------------------------- fingerprints

def _digest(data):
    count = [0] * 128
    for i in range(len(data) - 2):
        key = data[i] << 16 | data[i + 1] << 8 | data[i + 2]
        count[(key * 0x9E3779B1 & 0xFFFFFFFF) >> 25] += 1
    q = sorted(count)
    return [sum(c > q[k] for k in (31, 63, 95)) for c in count] + [min(255, round(8 * math.log2(len(data) + 1)))]


def _like(a, b):
    apart = sum((0, 1, 2, 6)[abs(x - y)] for x, y in zip(a[:128], b[:128])) + min(64, abs(a[128] - b[128]))
    return 1 - min(apart, 256) / 256


def _expected_fingerprints(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    out = []
    for i, (k, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edit = t[: len(t) - half] + nxt[:half]
        a, b, c = (_digest(x.encode()) for x in (t, edit, nxt))
        assert fingerprint.undigest(fingerprint.digest(np.asarray(a, np.uint8))).tolist() == a
        out.append((k, len(t), fingerprint.digest(np.asarray(a, np.uint8)), hashlib.sha256(edit.encode()).hexdigest(),
                    fingerprint.digest(np.asarray(b, np.uint8)), _like(a, b), _like(a, c)))
    return out


def test_op7_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in _table(spark, SF, "documents").collect()]
    got = sorted(map(tuple, queries.QUERIES["op7_fingerprints"](spark, SF).collect()))
    assert got == _expected_fingerprints(rows)


def test_fingerprints_of_hard_rows(spark, hard):
    small = hard.where("length(text) < 1000 or text is null")
    rows = [(r.doc_id, r.text) for r in small.collect()]
    key = lambda r: tuple((x is not None, x or 0 if not isinstance(x, str) else x) for x in r)
    got = sorted(map(tuple, fingerprint.compare_with_edits(small.repartition(5)).collect()), key=key)
    assert got == sorted(_expected_fingerprints(rows), key=key)
    assert fingerprint.compare_with_edits(hard.limit(0)).count() == 0
    (one,) = fingerprint.compare_with_edits(small.where("doc_id = 7")).collect()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256("ça ça".encode()).hexdigest()


# ---------------------------------------------------------------- token counts

def test_trie_equals_plain_recurrence(spark):
    c = tokencount.Counter(tokencount.Vocabulary.of_model())
    words = sorted({w for r in _table(spark, SF, "documents").limit(60).collect() for w in WORD.findall(r.text)}) + ["日本語😀", "é", "a" * 63, "x" * 300, "\x1c"]
    got = c.count(pa.array(words))
    assert got.tolist() == [c.one(tokencount.WORD_START + w) for w in words]


def test_segmentation_is_the_best_of_all():
    v = tokencount.Vocabulary.ranked(["a", "b", "ab", "ba", "aba", "▁", "▁a"])
    c = tokencount.Counter(v)

    def best(s):
        if not s:
            return 0, 0
        out = []
        for m in range(1, len(s) + 1):
            score = v.scores.get(s[:m])
            if score is None and m == 1:
                n = len(s[0].encode())
                rest = best(s[1:])
                out.append((n * ((v.byte_score + 1) // tokencount.UNIT) + rest[0], rest[1] - n))
            elif score is not None:
                rest = best(s[m:])
                out.append(((score + 1) // tokencount.UNIT + rest[0], rest[1] - 1))
        return max(out)

    rng = np.random.default_rng(2)
    words = sorted({"".join(rng.choice(list("abcé"), rng.integers(1, 9))) for _ in range(150)})
    assert c.count(pa.array(words)).tolist() == [-best("▁" + w)[1] for w in words]


def test_op5_on_the_table_and_hard_rows(spark, hard):
    c = tokencount.Counter(tokencount.Vocabulary.of_model())
    for got, docs in ((queries.QUERIES["op5_token_counts"](spark, SF), _table(spark, SF, "documents")), (tokencount.count_tokens(hard), hard)):
        memo = {}
        want = []
        for r in docs.collect():
            ws = WORD.findall(r.text or "")
            want.append((r.doc_id, len(ws), sum(memo.setdefault(w, c.one("▁" + w)) if w not in memo else memo[w] for w in ws)))
        key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
        assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert tokencount.count_tokens(hard.limit(0)).count() == 0
