"""Permutation index, Merkle manifest and source divergence against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from docsift.llm import divergence, merkle, permutation_index, queries

SF = "/root/testdata/sf0.001"


def _twin(name, **tables):
    con = duckdb.connect()
    for t, path in tables.items():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return Counter(con.sql(queries.SQL[name]).fetchall())


# ---------------------------------------------------------------- permutation index

def _nearest(rows, query, k):
    """Ids and scores of the k best rows (id, vector) for one (id, vector)."""
    scored = [(-math.fsum(a * b for a, b in zip(v, query[1])), i is None, i or 0) for i, v in rows if i != query[0]]
    return [(None if none else i, -s) for s, none, i in sorted(scored)[:k]]


def _usable(v, dimension):
    return v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_index_finds_the_nearest_of_a_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    own = [(r.vec_id, r.embedding) for r in rows.collect()]
    got = defaultdict(list)
    for r in permutation_index.neighbours(rows, rows.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    asked = [(i, v) for i, v in own if i % 20 == 0]
    assert sorted(got) == sorted(i for i, _ in asked)
    hits, scores = 0, dict(own)
    for i, v in asked[:40]:
        best = {x for x, _ in _nearest(own, (i, v), 20)}
        found = got[i]
        assert [r for r, _, _ in found] == list(range(1, 21)) and i not in {x for _, x, _ in found}
        assert [(-s, x) for _, x, s in found] == sorted((-s, x) for _, x, s in found)
        assert all(s == math.fsum(a * b for a, b in zip(scores[x], v)) for _, x, s in found)
        hits += len(best & {x for _, x, _ in found})
    assert hits >= 0.9 * 20 * 40


def test_index_of_hard_vectors_is_exact_when_all_are_reranked(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).round(1).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[40][1]) for i in range(30)]  # copies tie
    rows += [(2000 + i, [1e-3 * x for x in rows[i][1]]) for i in range(20)] + [(2100, [1e100] * 5), (2120, [1e-100] * 5)]
    rows += [(None, [9.0, 9, 9, 9, 9]), (60, [1.0, 0, 0, 0, 0]), (20, rows[20][1]), (3000, None), (3020, []), (3040, [0.0] * 5),
             (3060, [1.0, None, 0, 0, 0]), (3080, [1.0, float("nan"), 0, 0, 0]), (3100, [1.0, float("inf"), 0, 0, 0]), (3120, [1.0] * 4)]
    rows = [(i, v and [x if x is None else float(x) for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("own") for c in ("id", "vector", "norm", "rank", "score", "stripe", "n")})
    got = defaultdict(list)
    asked = df.where("vec_id % 20 = 0")
    for r in permutation_index.neighbours(df, asked, k=25, share=1.0, pivots=32, prefix=8).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    good = [(i, v) for i, v in rows if _usable(v, 5)]
    want = defaultdict(list)
    seen = set()
    for i, v in good:
        if i is not None and i % 20 == 0 and (i, tuple(v)) not in seen:
            seen.add((i, tuple(v)))
            want[i] += [(n + 1, x, s) for n, (x, s) in enumerate(_nearest(good, (i, v), 25))]
    order = lambda x: (x[0], x[1] is None, x[1] or 0, x[2])
    assert {q: sorted(v, key=order) for q, v in got.items()} == {q: sorted(v, key=order) for q, v in want.items()}


def test_copies_and_few_rows(spark):
    one = [0.6, 0.8]
    copies = spark.createDataFrame([(i, one) for i in range(2000)], "vec_id long, embedding array<float>")
    got = permutation_index.neighbours(copies, copies.where("vec_id in (0, 1980)"), k=3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, 1), (0, 2), (0, 3), (1980, 0), (1980, 1), (1980, 2)]
    few = copies.limit(3)
    assert permutation_index.neighbours(few, few.where("vec_id = 0")).count() == 2
    for none in (copies.limit(0), copies.where("vec_id < 0"), copies.withColumn("embedding", F.lit(None).cast("array<float>"))):
        assert permutation_index.neighbours(none, none).count() == 0
    assert permutation_index.neighbours(copies, copies.limit(0)).count() == 0


def test_likeness_is_the_footrule_distance():
    rng = np.random.default_rng(0)
    pivots, prefix = 30, 7
    rows = np.stack([rng.permutation(pivots)[:prefix] for _ in range(50)]).astype(np.int16)
    asked = np.stack([rng.permutation(pivots)[:prefix] for _ in range(9)]).astype(np.int16)
    got = permutation_index.likeness(asked, permutation_index.inverted_files(rows, pivots), len(rows))

    def footrule(a, b):
        place = lambda x, p: x.index(p) if p in x else prefix
        return sum(abs(place(a, p) - place(b, p)) for p in set(a) | set(b))

    for q, row in zip(asked.tolist(), got.tolist()):
        for r, like in zip(rows.tolist(), row):
            assert footrule(q, r) == prefix * (prefix + 1) - 2 * like


# ---------------------------------------------------------------- Merkle manifest

def _hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_hash("".join(levels[-1][i: i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def _siblings(levels, i):
    for level in levels[:-1]:
        lo = i // 16 * 16
        yield "".join(level[lo:i]), "".join(level[i + 1: lo + 16])
        i //= 16


def _manifest(rows):
    """(id, leaf, subroot, root, proof, folded root) of (id, tree, fields, tampered fields or None)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda fields: _hash("".join(map(field, fields)))
    by = defaultdict(list)
    for i, tree, fields, other in rows:
        by[tree].append((i is not None, i or 0, leaf(fields), leaf(other) if other else None, i))
    trees = {t: _tree([x[2] for x in sorted(v, key=lambda x: x[:3])]) for t, v in by.items()}
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    top = _tree([trees[t][-1][0] for t in names])
    for place, t in enumerate(names):
        for n, (_, _, own, other, i) in enumerate(sorted(by[t], key=lambda x: x[:3])):
            path = [*_siblings(trees[t], n), *_siblings(top, place)]
            folded = other or own
            for left, right in path:
                folded = _hash(left + folded + right)
            yield i, own, trees[t][-1][0], top[-1][0], _hash("".join(a + b for a, b in path)), folded


def _run(df):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    out = merkle.manifest(df, changed={"text": F.translate("text", merkle.UPPER, merkle.LOWER)}, where=hit)
    rows = out.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert all(r.verified == (r.folded_root == r.root) for r in rows)
    return Counter(tuple(r)[:6] for r in rows)


def _fields(rows):
    for i, text, lang, source, n in rows:
        tampered = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        low = None if text is None else text.translate({c: c + 32 for c in range(65, 91)})
        yield i, source, (i, source, lang, n, text), (i, source, lang, n, low) if tampered else None


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16}, {"a": 17, None: 1, "": 2}, {"a": 4096, "é": 3}, {"a": 4097, "b": 5000, "B": 40},
                                   {f"s{i}": 1 + i % 3 for i in range(300)}])
def test_manifest_of_trees_of_many_sizes(spark, sizes):
    rows = [(1000 * i + n, f"Text {n}", "en", s, n) for i, (s, many) in enumerate(sizes.items()) for n in range(many)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert _run(df) == Counter(_manifest(_fields(rows)))


def test_manifest_of_hard_rows(spark):
    texts = [None, "", "A", "ÄB -:", "Long " * 200_000, "same", "same"]
    rows = [(i, t, None if i % 2 else "en", None if i % 3 == 0 else "s", None) for i, t in enumerate(texts)]
    rows += [(None, "X", None, "s", 1), (5, "same", None, "s", None), (5, "other", None, "s", None), (None, None, None, None, None)] * 2
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema).withColumns({c: F.lit("own") for c in ("id", "tree", "digest", "other", "place", "n")})
    assert _run(df) == Counter(_manifest(_fields(rows)))
    assert merkle.manifest(df.limit(0)).count() == 0


def test_manifest_query_equals_its_sql(spark):
    got = Counter(tuple(r) for r in queries.QUERIES["op12_merkle_manifest"](spark, SF).collect())
    assert got == _twin("op12_merkle_manifest", documents=f"{SF}/documents.parquet")


def test_sweeps_keep_few_messages_and_agree():
    nodes = [_hash(str(i)) for i in range(700)]
    found = merkle.sweep_up(iter(nodes), 3)
    assert found == _tree(nodes)
    for place, path in merkle.sweep_down(found, (("L", "R"), ())):
        assert list(merkle._steps(path)) == [*_siblings(found, place), ("L", "R")]
        assert merkle._path(merkle._text(path)) == path


# ---------------------------------------------------------------- source divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _audit(rows, min_docs=10, top=10):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        own = sorted(s for x, s in groups if x == lang)
        total = {t: sum(count[lang, s][t] for s in own) for t in kept}

        def chances(c):
            down = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // down for t in kept}

        p, q = {s: chances(count[lang, s]) for s in own}, chances(total)
        price = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = sorted((-sum(price(p[s][t], p[o][t]) for t in kept), o.encode()) for o in own if o != s)
            terms = sorted((-price(p[s][t], q[t]), t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t])
            out |= {(lang, s, part, x.decode(), -v, n + 1) for part, found in (("pair", pairs), ("term", terms[:top])) for n, (v, x) in enumerate(found)}
    return out


def test_divergence_of_hard_rows(spark):
    texts = [None, "", " 12 _ ", "Ab aB-ab é·é İx", "the end " * 50_000, "word " * 3, "\x00a\x7fb[c]d{e}"]
    rows = [(texts[i % 7], None if i % 11 == 0 else f"l{i % 2}", None if i % 5 == 0 else f"s{i % 4}") for i in range(120)]
    rows += [("", "empty", "s0"), (None, "empty", "s1"), (None, "empty", None)] + [("x y z", "l1", "hot")] * 200
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumns(
        {c: F.lit("own") for c in ("term", "n", "docs", "total", "part", "a", "b", "p", "rank", "class", "block", "size")})
    got = {tuple(r) for r in divergence.audit(df).collect()}
    assert got == _audit(rows)
    assert divergence.audit(df.limit(0)).count() == 0


def test_divergence_of_many_sources(spark):
    """More groups than a block, terms that most blocks lack."""
    rng = np.random.default_rng(5)
    rows = [(" ".join(f"w{chr(97 + x)}" for x in rng.integers(0, 20, 5)) + (" rare" if i % 50 == 0 else ""), "en", f"s{i % 290}") for i in range(900)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = {tuple(r) for r in divergence.audit(df, min_docs=5, top=3).collect()}
    assert got == _audit(rows, 5, 3)


def test_divergence_query_equals_its_sql(spark):
    got = Counter(tuple(r) for r in queries.QUERIES["op13_source_divergence"](spark, SF).collect())
    assert got == _twin("op13_source_divergence", documents=f"{SF}/documents.parquet")


def test_joint_prices_equal_direct_sums(monkeypatch):
    monkeypatch.setattr(divergence, "COLUMNS", 20)
    rng = np.random.default_rng(1)
    levels = np.sort(rng.integers(0, 40, (60, 5)), axis=0)
    levels[:, 3] = 0
    chances = 7 * levels + np.arange(5) + 1
    term, group = np.nonzero(levels)
    every = np.ones(5, bool)
    term = np.unique(term, return_inverse=True)[1]
    got = divergence.joint_prices(term, group, levels[levels > 0], chances[levels > 0], np.arange(5) + 1, every, every)
    used = (levels > 0).any(1)
    for i in range(5):
        for j in range(i + 1, 5):
            a, b = chances[used, i], chances[used, j]
            assert got[i, j] == ((a - b) ** 2 // (a + b)).sum()
