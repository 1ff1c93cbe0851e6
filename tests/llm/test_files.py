"""Token files, archives: exact round trips."""

import base64
import gzip
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docsift.llm import arrow_sequences as A
from docsift.llm import queries, warc
from docsift.llm.common import work_path
from docsift.llm.tokens import Encoder, default_path

SF = "/root/testdata/sf0.001"
TEXTS = ["Hello world", "", None, " \t\n", "ok ok ok", "\"quote\" <|endoftext|> don't", "Ünïcode ẞ İ ﬁ 日本語 ١٢", "a" * 30_000,
         "word " * 9000, "Hello world", "x,y;z !!a a!! '\x0b\x0c\r\n\x1c\x85q"]


def _library(texts):
    tok = Encoder.of().tokenizer
    return [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.fixture()
def hard(spark):
    rows = [(i if i != 3 else None, t, "src", f"p{i}") for i, t in enumerate(TEXTS)] + [(4, "ok ok ok", "src", "again")] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, shard string, tokens string")


def test_encoder_equals_the_library():
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("aB'é́ .,!\n1_İß<|>Σ日≠") for _ in range(60)) for _ in range(2000)]
    enc = Encoder(default_path(), cache_chunks=300)
    for lo in range(0, len(texts), 400):  # the small cache is emptied many times
        ids, off = enc.encode(pa.array(texts[lo: lo + 400], pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == _library(texts[lo: lo + 400])


def test_encoder_without_space_rule():
    enc = Encoder(default_path("byte_bpe_50k.json"))
    assert not enc.by_chunk
    ids, off = enc.encode(pa.array(["a b", None]))
    assert ids.tolist() == enc.tokenizer.encode("a b").ids and off.tolist() == [0, len(ids), len(ids)]


def test_stream_file_is_zero_copy(tmp_path):
    ids = np.arange(25, dtype=np.uint32)
    data = A.stream_bytes(ids, np.asarray([5, 25]), [7, None], 8, 49408, batch_rows=2, meta={"shard": 3, "part": 1})
    path = tmp_path / "x.arrow"
    path.write_bytes(data.to_pybytes() + A.END_OF_STREAM)
    with pa.memory_map(str(path)) as f:
        before = pa.total_allocated_bytes()
        schema, batches = A.open_sequences(f)
        assert pa.total_allocated_bytes() - before < 1000  # views of the map
        assert [b.num_rows for b in batches] == [2, 2]
        assert batches[1].column("input_ids")[1].as_py() == [24] + [0] * 7  # row 3 by its place
        assert batches[1].column("mask")[1].as_py() == [True] + [False] * 7
        got, mask = A.sequence(batches, 3)
        assert got.tolist() == [24] + [0] * 7 and mask.to_pylist() == [True] + [False] * 7 and not got.flags.owndata
        assert A.sequence(batches, 1)[0].tolist() == list(range(8, 16))
        f.seek(0)
        meta, flat, names, ends = A.file_documents(f)
    assert meta == {"shard": 3, "part": 1, "tokens": 25} and flat.tolist() == ids.tolist()
    assert names == [7, None] and ends.tolist() == [5, 25]


def test_sequences_round_trip(spark, hard):
    path = work_path(spark, "t")
    A.write_sequences(hard, path, seq_len=64, file_tokens=500, shards=3)
    got = A.read_sequences(spark, path, with_ids=True).collect()
    rows = sorted([(r.doc_id, r.text) for r in hard.collect()], key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, at = [], 0
    for (k, _), ids in zip(rows, _library([t for _, t in rows])):
        b = np.asarray([*ids, 1], "<u4").tobytes()
        want.append((k, at, len(b) // 4, zlib.crc32(b), b))
        at += len(b) // 4
    order = lambda r: r[1]
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in got], key=order) == want


def test_sequences_of_an_empty_table(spark, hard):
    path = work_path(spark, "t")
    A.write_sequences(hard.limit(0), path)
    assert A.read_sequences(spark, path).collect() == []


def test_op3_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = queries.QUERIES["op3_arrow_sequences"](spark, SF).orderBy("doc_id").collect()
    at = 0
    for d, ids, r in zip(docs, _library([d.text for d in docs]), got, strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (d.doc_id, at, len(ids) + 1)
        assert r.ids_crc32 == zlib.crc32(np.asarray([*ids, 1], "<u4").tobytes())
        at += len(ids) + 1


# ---------------------------------------------------------------- archives

def _one(i, payload, refers=None, url="http://x/"):
    return warc.record(i, url, payload, hashlib.sha1(payload).hexdigest(), refers, "1970-01-01T00:00:00Z")


def _ids(data):
    return [(e["kind"], e.get("fields", {}).get("warc-record-id"), e["offset"], e["length"]) for e in warc.salvage(data)]


def _plain(n=5):
    return [_one(i, f"payload {i} WARC/1.1\r\n".encode() * (i + 1)) + warc.CLOSING for i in range(n)]


def _packed(n=5):
    return [gzip.compress(_one(i, f"payload {i}".encode() * (i + 1)), mtime=0) + warc.CLOSING_MEMBER for i in range(n)]


@pytest.mark.parametrize("made", [_plain, _packed])
def test_undamaged(made):
    parts = made()
    got = _ids(b"".join(parts))
    assert [g[:2] for g in got] == [("record", f"<urn:x-page:{i}>") for i in range(5)]
    assert [g[2] for g in got] == np.cumsum([0, *map(len, parts)])[:-1].tolist()


@pytest.mark.parametrize("made", [_plain, _packed])
def test_every_damaged_byte_costs_one_record_at_most(made):
    parts = made()
    data, starts = b"".join(parts), np.cumsum([0, *map(len, parts)])
    for at in range(0, len(data), 7):
        bad = bytearray(data)
        bad[at] ^= 0x55
        got = _ids(bytes(bad))
        hit = int(np.searchsorted(starts, at, side="right")) - 1
        found = {g[1] for g in got if g[0] == "record"}
        assert found >= {f"<urn:x-page:{i}>" for i in range(5) if i != hit}, at
        covered = sum(g[3] for g in got)
        assert covered <= len(data)


@pytest.mark.parametrize("made", [_plain, _packed])
def test_gaps_are_logged_exactly(made):
    parts = made()
    junk = b"\x00garbage WARC/9.9 \x1f\x8b\x08 more\n"
    data = junk + parts[0] + parts[1][:40] + parts[2] + junk + parts[3] + parts[4][:-30]
    got = list(warc.salvage(data))
    gaps = [(e["offset"], e["length"]) for e in got if e["kind"] == "gap"]
    a = len(junk) + len(parts[0])
    b = a + 40 + len(parts[2])
    c = b + len(junk) + len(parts[3])
    assert gaps[:3] == [(0, len(junk)), (a, 40), (b, len(junk))] and gaps[3][0] == c
    assert sum(gaps[3]) == len(data) if made is _plain else True
    assert [e["fields"]["warc-record-id"] for e in got if e["kind"] == "record"] == [f"<urn:x-page:{i}>" for i in (0, 2, 3)]
    assert all(e["reason"] for e in got if e["kind"] == "gap")


def test_checks_and_odd_files():
    assert _ids(b"") == [] and [g[0] for g in _ids(b"no archive")] == ["gap"]
    assert _ids(b"\r\n\r\n") == []
    whole = gzip.compress(b"".join(_plain()))  # one member for the whole file
    assert [g[0] for g in _ids(whole)] == ["record"] * 5
    mixed = _plain()[0] + _packed()[1] + _plain()[2]
    assert [g[1] for g in _ids(mixed)] == [f"<urn:x-page:{i}>" for i in range(3)]
    wrong = _plain(1)[0].replace(b"payload 0", b"payload X")
    assert next(iter(warc.salvage(wrong)))["reason"] == "block digest differs"
    head = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <a>\r\nX-Long: a\r\n b\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    (e,) = warc.salvage(head)
    assert e["payload"] == b"hi" and e["fields"]["x-long"] == "a b" and e["payload_digest"] == hashlib.sha1(b"hi").hexdigest()
    for broken in (head.replace(b"2\r\n\r\n", b"-2\r\n\r\n"), head.replace(b"WARC-Type: resource\r\n", b""),
                   head.replace(b"X-Long", b"X Long"), head[:-4], head.replace(b"\r\n\r\nhi", b"\r\nhi")):
        assert [e["kind"] for e in warc.salvage(broken)] == ["gap"]
    hexed = head.replace(b"X-Long: a\r\n b", b"WARC-Block-Digest: sha1:" + hashlib.sha1(b"hi").hexdigest().upper().encode())
    assert [e["kind"] for e in warc.salvage(hexed)] == ["record"]
    assert base64.b32encode(hashlib.sha1(b"hi").digest())


def test_archive_round_trip_of_hard_rows(spark):
    big = "é" * 800
    rows = [(1, "http://a", big), (5, "http://b\r\nX: y", big), (3, None, big), (None, "u", big), (5, "http://c", big),
            (2, "u", None), (4, "u", ""), (6, "u", "x" * 999), (7, "u", "x" * 999), (8, "u", "\r\n\r\nWARC/1.1\r\n" * 300),
            (9, "u", "z" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("key", F.lit(1))
    for compress in (True, False):
        path = work_path(spark, "t")
        warc.write_archives(pages, path, file_bytes=4000, compress=compress)
        got = warc.read_archives(spark, path, with_payload=True).collect()
        assert all(r.kind == "record" for r in got) and len(got) == len(rows)
        want = []
        for i, _, html in rows:
            p = (html or "").encode()
            refers = 5 if html == big and i != 5 else None
            want.append((f"<urn:x-page:{'' if i is None else i}>", "revisit" if refers else "response",
                         f"<urn:x-page:{refers}>" if refers else None, len(p), hashlib.sha1(p).hexdigest(), b"" if refers else p))
        key = lambda r: (r[0], r[1], r[3])
        assert sorted([(r.record_id, r.warc_type, r.refers_to, r.payload_bytes, r.payload_digest, bytes(r.payload)) for r in got], key=key) == sorted(want, key=key)
    warc.write_archives(pages.limit(0), path := work_path(spark, "t"))
    assert warc.read_archives(spark, path).collect() == []
