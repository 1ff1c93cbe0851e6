"""The text index against the operators that read the texts."""

import random

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from docsift.functions import predicates as P
from docsift.operators import postings
from docsift.operators import text as X
from docsift.operators.postings import PostingsIndex, _blocks, merge, pack
from docsift.operators.write import apply_actions

WORDS = ["the", "ant", "Bee", "cat", "dog", "éa", "x1", "日本"]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(WORDS, [30, 9, 6, 4, 3, 2, 1, 1], k=rng.randint(1, 30))) for _ in range(300)]
    texts += [None, "", "...", "a a a b a", "b a a", "The-the; THE", "rare " + "the " * 3000, "cat\ncat"]
    return spark.createDataFrame(list(enumerate(texts)), "id long, body string").cache()


@pytest.fixture(scope="module")
def index(docs, tmp_path_factory):
    return PostingsIndex.build(docs, str(tmp_path_factory.mktemp("index")), "body", buckets=4, slice_docs=20)


@pytest.fixture(scope="module")
def changed(spark, docs, tmp_path_factory):
    """An index after two feeds, the second of which touches the first's documents."""
    index = PostingsIndex.build(docs, str(tmp_path_factory.mktemp("changed")), "body", buckets=4, slice_docs=20)
    one = [(i, i, "index", f"new the cat {i} cat") for i in range(0, 40, 3)] + [(900 + i, i, "create", "the ant brand new") for i in range(5)] + [(7, 1, "delete", None), (5555, 1, "delete", None)]
    two = [(3, 1, "delete", None), (900, 2, "update", "a a rare bee"), (7, 3, "index", "back the dog"), (8, 4, "update", None)]
    now = docs
    for rows in (one, two):
        feed = spark.createDataFrame(rows, "id long, seq long, action string, body string")
        index.refresh(now, feed, "body")
        now = apply_actions(now, feed, "id").cache()
    return index, now


QUERIES = ["the", "the cat", "bee dog x1", "rare", "ÉA 日本", "nothing", "cat nothing the", ""]


def _same_ranking(index, docs, text, k):
    want = [(r.id, round(r.score, 12)) for r in X.bm25_top_k(docs, "body", text, k, "id").collect()] if text else []
    assert [(r.id, round(r.score, 12)) for r in index.bm25_top_k(text, k).collect()] == want


@pytest.mark.parametrize("text", QUERIES)
@pytest.mark.parametrize("k", [3, 500])
def test_ranking_equals_scoring_everything(index, docs, text, k):
    _same_ranking(index, docs, text, k)


@pytest.mark.parametrize("text", ["the cat", "rare new", "a bee"])
def test_ranking_after_feeds(changed, tmp_path, text):
    index, now = changed
    _same_ranking(index, now, text, 20)
    _same_ranking(index.compact(str(tmp_path / "compact")), now, text, 20)
    n = now.agg(F.count(F.lit(1)), F.count("body")).first()
    assert index.totals()[:2] == (n[0], n[1]) and index.documents().count() == n[0]


def test_matches_and_phrases(index, docs, changed):
    ids = lambda df: sorted(r.id for r in df.select("id").collect())
    for ix, df in ((index, docs), changed):
        for text in ("the cat", "a a", "a b a", "cat cat", "the the the", "the", "cat brand", "éa x1 日本"):
            assert ids(ix.phrase(text)) == ids(df.where(P.match_phrase("body", text))), text
            assert ids(ix.match(text)) == ids(df.where(P.match("body", text))), text
            assert ids(ix.match(text, "and")) == ids(df.where(P.match("body", text, "and"))), text
            assert ids(ix.match(text, minimum_should_match=2)) == ids(df.where(P.match("body", text, minimum_should_match=2))), text
        assert ids(ix.phrase("")) == ids(ix.match("")) == []


@pytest.mark.parametrize("options", [{}, {"max_query_terms": 2, "min_doc_freq": 2, "max_doc_freq_ratio": 0.9}, {"min_term_freq": 2, "minimum_should_match": 2}])
def test_more_like_this(index, docs, changed, options):
    for ix, df in ((index, docs), changed):
        for like in (4, 303, 999):
            want = X.more_like_this(df, "body", "id", like, k=15, **options).collect()
            assert ix.more_like_this(df, "body", "id", like, k=15, **options).collect() == want


def test_a_query_reads_its_own_buckets_and_few_slices(spark, index):
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(index.match("rare")._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(", "") or "bucket#" in plan.split("PartitionFilters: [")[1][:200]
    assert "(term,rare)" in plan or "In(term, [rare])" in plan
    assert "places" not in plan.split("ReadSchema: ")[1].split("\n")[0]
    # the bar of the first round leaves slices out
    best = index.bm25_top_k("rare the", 1)
    assert best.first()["id"] == 306
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(best._jdf.queryExecution(), "formatted")
    assert "slice" in plan.split("PushedFilters: [")[1].split("\n")[0]


def test_repeated_or_missing_ids_are_refused(spark, tmp_path):
    for rows in ([(1, "a"), (1, "b")], [(None, "a")]):
        with pytest.raises(Exception, match="unique"):
            PostingsIndex.build(spark.createDataFrame(rows, "id long, body string"), str(tmp_path / str(len(rows))), "body")


def test_empty_table_and_text_ids(spark, tmp_path):
    none = PostingsIndex.build(spark.createDataFrame([], "id string, body string"), str(tmp_path / "none"), "body")
    assert none.bm25_top_k("a", 3).count() == none.match("a").count() == none.phrase("a b").count() == 0
    some = PostingsIndex.build(spark.createDataFrame([("k1", "a b"), ("k2", "b")], "id string, body string"), str(tmp_path / "text"), "body")
    assert [r.id for r in some.phrase("a b").collect()] == ["k1"] and [r.id for r in some.bm25_top_k("b", 5).collect()] == ["k2", "k1"]


def test_unfinished_segments_are_not_read(docs, spark, tmp_path):
    path = str(tmp_path / "index")
    index = PostingsIndex.build(docs, path, "body", buckets=4)
    before = index.match("the").count()
    spark.createDataFrame([("the", 0, 1, 1, 1, [99_999], [1], [1], [[0]], 0)],
                          "term string, slice int, n int, top_tf int, least_length int, ids array<long>, tfs array<int>, lengths array<int>, "
                          "places array<array<int>>, bucket int").write.partitionBy("bucket").parquet(f"{path}/postings/segment=1")
    assert PostingsIndex(spark, path).match("the").count() == before


def test_blocks_hold_every_place(spark):
    docs = spark.createDataFrame([(1, "b a, B c a"), (2, None), (3, "a"), (4, "")], "id long, text string")
    got = {(r.term, i): p for r in _blocks(docs, 3, 2).collect() for i, p in zip(r.ids, r.places)}
    assert got == {("a", 1): [1, 4], ("b", 1): [0, 2], ("c", 1): [3], ("a", 3): [0]}
    assert {(r.bucket, r.slice, r.n) for r in _blocks(docs, 1, 1).collect()} == {(0, 0, 2), (0, 0, 1)}


def test_packed_rows_of_many_batches_merge(spark):
    docs = spark.range(2000).selectExpr("id", "concat('t', id % 7, ' t', id % 3, ' t', id % 7) AS text").repartition(5)
    got = {}
    for r in _blocks(docs, 2, 100).collect():
        assert r.ids == sorted(r.ids) and r.n == len(r.ids) and r.top_tf == max(r.tfs) and set(r.lengths) == {3}
        for i, tf, p in zip(r.ids, r.tfs, r.places):
            assert (r.term, i) not in got and tf == len(p)
            got[r.term, i] = p
    want = {}
    for i in range(2000):
        for n, w in enumerate((f"t{i % 7}", f"t{i % 3}", f"t{i % 7}")):
            want.setdefault((w, i), []).append(n)
    assert got == want


def test_very_long_texts_are_packed_wider():
    """Places beyond 65,535 and batches with and without such texts."""
    kind = pa.schema([("id", pa.int64()), ("slice", pa.int32()), ("tokens", pa.list_(pa.string()))])
    texts = {1: ["a"] * 70_000 + ["b"], 2: ["b", "a"], 3: None, 4: ["a"]}
    batches = [pa.record_batch([pa.array(ids), pa.array([i % 2 for i in ids], pa.int32()), pa.array([texts[i] for i in ids], pa.list_(pa.string()))], schema=kind)
               for ids in ([1, 3], [2, 4])]
    packed = [pack(b, 1) for b in batches]
    assert [set(p.column("width").to_pylist()) for p in packed] == [{4}, {2}]
    got = {}
    for deal in (0, 1):
        rows = pa.Table.from_batches(packed).filter(pa.compute.field("deal") == deal)
        for r in merge(rows).to_pylist():
            assert r["lengths"] == [len(texts[i]) for i in r["ids"]] and r["slice"] == deal
            got |= {(r["term"], i): p for i, p in zip(r["ids"], r["places"])}
    assert got == {("a", 1): list(range(70_000)), ("b", 1): [70_000], ("a", 2): [1], ("b", 2): [0], ("a", 4): [0]}


def _held(monkeypatch):
    """Tokens of each call of :func:`merge`, in this process."""
    sizes = []

    def noted(rows):
        out = merge(rows)
        sizes.append(sum(sum(tfs) for tfs in out.column("tfs").to_pylist()))
        return out

    monkeypatch.setattr(postings, "merge", noted)
    return sizes


class _Frame:
    """Stands for the frames of ``_blocks``: keeps the functions that it gives to the tasks."""

    def __init__(self, schema):
        self.schema, self.steps = schema, []

    def mapInArrow(self, step, schema):
        self.steps.append(step)
        return self

    def select(self, *_):
        return self

    repartition = sortWithinPartitions = select


@pytest.mark.parametrize("docs_of_a_slice", [1000, 50])
def test_merged_tokens_do_not_grow_with_the_collection(spark, monkeypatch, docs_of_a_slice):
    monkeypatch.setattr(postings, "PACKED_TOKENS", 200)
    monkeypatch.setattr(postings, "MERGED_TOKENS", 1000)
    sizes = _held(monkeypatch)
    kind = pa.schema([("id", pa.int64()), ("slice", pa.int32()), ("tokens", pa.list_(pa.string()))])
    most = {}
    for n in (2_000, 20_000):
        slices = n // docs_of_a_slice
        frame = _blocks(_Frame(spark.range(1).schema), 1, slices)
        rows = pa.record_batch([pa.array(range(n)), pa.array([i % slices for i in range(n)], pa.int32()), pa.array([["the", f"w{i % 9}"] for i in range(n)])], schema=kind)
        packed = pa.Table.from_batches(list(frame.steps[0](iter([rows])))).sort_by([("bucket", "ascending"), ("deal", "ascending")])
        sizes.clear()
        blocks = pa.Table.from_batches(list(frame.steps[1](iter(packed.combine_chunks().to_batches(max_chunksize=70)))))
        most[n] = max(sizes)
        # every posting once, whatever is merged together
        got = sorted((t, i) for t, ids in zip(blocks["term"].to_pylist(), blocks["ids"].to_pylist()) for i in ids)
        assert got == sorted([("the", i) for i in range(n)] + [(f"w{i % 9}", i) for i in range(n)])
        assert sum(blocks["n"].to_pylist()) == 2 * n
    assert most[20_000] <= 1000 and most[2_000] <= 1000


def test_blocks_merged_in_parts_answer_alike(spark, docs, monkeypatch, tmp_path):
    """Several blocks of one term and slice."""
    blocks = _blocks(docs.select("id", F.col("body").alias("text")), 2, 3).collect()
    rows = [(b.term, b.slice, 1, tf, n, [i], [tf], [n], [p], b.bucket) for b in blocks for i, tf, n, p in zip(b.ids, b.tfs, b.lengths, b.places)]
    whole = PostingsIndex.build(docs, str(tmp_path / "whole"), "body", buckets=2, slice_docs=103)
    split = PostingsIndex.build(docs, str(tmp_path / "split"), "body", buckets=2, slice_docs=103)
    kind = "term string, slice int, n int, top_tf int, least_length int, ids array<long>, tfs array<int>, lengths array<int>, places array<array<int>>, bucket int"
    spark.createDataFrame(rows, kind).write.mode("overwrite").partitionBy("bucket").parquet(str(tmp_path / "split" / "postings" / "segment=0"))
    for text in ("the cat", "rare", "a b a", "bee dog x1"):
        assert split.bm25_top_k(text, 7).collect() == whole.bm25_top_k(text, 7).collect()
        for f in ("match", "phrase"):
            assert sorted(getattr(split, f)(text).collect()) == sorted(getattr(whole, f)(text).collect())
    assert split.more_like_this(docs, "body", "id", 4).collect() == whole.more_like_this(docs, "body", "id", 4).collect()
    assert split.compact(str(tmp_path / "one"))._postings().count() == whole._postings().count()
