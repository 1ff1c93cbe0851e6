"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (arrow_sequences, divergence, fingerprint, langid, merkle, mixing, ngram_join, packing, permutation_index, quality,
               tokencount, toxicity, warc)
from .common import documents, work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


@register("op3_arrow_sequences")
def op3_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "sequences")
    arrow_sequences.write_sequences(documents(spark, sf_dir), path)
    return arrow_sequences.read_sequences(spark, path)


@register("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(documents(spark, sf_dir)))


@register("op1_warc_salvage", """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
           max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM p
""")
def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "warc")
    warc.write_archives(documents(spark, sf_dir, "pages"), path)
    read = warc.read_archives(spark, path).where("kind = 'record'")
    number = lambda c: F.when(warc.page_number(c) != "", warc.page_number(c)).cast("long")
    return read.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                       F.col("warc_type").alias("record_type"), number("refers_to").alias("refers_to"))


@register("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    trusted = documents(spark, sf_dir, "labels").where("quality = 1")
    scored = quality.score(docs, quality.fit(docs, trusted))
    return scored.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")])


@register("op9_pareto_mixing", """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w FROM s),
l AS (SELECT *, (2 * source_size)::DOUBLE / w AS level FROM w),
o AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
        - coalesce(sum(2 * source_size) OVER b, 0)::DOUBLE) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS water,
        row_number() OVER (ORDER BY level, source NULLS LAST) AS place
      FROM l WINDOW b AS (ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least((SELECT arg_min(water, place) FROM o WHERE water <= level) * w,
        (2 * source_size)::DOUBLE) AS target FROM o),
c AS (SELECT source, len(bin(size)) AS class, sum(size) AS class_size FROM d GROUP BY ALL),
u AS (SELECT c.source, class, class_size, source_size, target,
        CASE WHEN sum(class * class_size) OVER f > 0 THEN
          (target - coalesce(sum(2 * class_size) OVER b, 0)::DOUBLE) / (sum(class * class_size) OVER f)::DOUBLE END AS unit
      FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
      WINDOW b AS (PARTITION BY c.source ORDER BY class DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             f AS (PARTITION BY c.source ORDER BY class DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
v AS (SELECT source, max_by(unit, class) AS unit FROM u WHERE unit * class <= 2 GROUP BY source),
e AS (SELECT u.source, class, class_size, source_size, target, coalesce(least(v.unit * class, 2.0::DOUBLE), 0) AS expected
      FROM u LEFT JOIN v ON u.source IS NOT DISTINCT FROM v.source),
x AS (SELECT *, floor(expected) AS whole, target - sum(floor(expected) * class_size) OVER (PARTITION BY source) AS rest
      FROM e),
r AS (SELECT d.*, x.source_size, x.target, x.whole, x.rest, expected - whole AS p,
        (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE)
          / 4503599627370496::DOUBLE AS draw
      FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source AND len(bin(d.size)) = x.class),
q AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN (draw / (1 - draw)) / (p / (1 - p)) END AS rnk FROM r),
k AS (SELECT source, rnk, sum(size) AS size, any_value(rest) AS rest FROM q WHERE rnk IS NOT NULL GROUP BY source, rnk),
m AS (SELECT source, rnk, rest, size, sum(size) OVER (PARTITION BY source ORDER BY rnk) AS upto FROM k),
cut AS (SELECT source, max(rnk) AS cut FROM m WHERE upto - size::DOUBLE / 2 <= rest GROUP BY source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       CASE WHEN size > 0 THEN (whole + CASE WHEN rnk <= cut THEN 1 ELSE 0 END)::BIGINT * size ELSE 0 END AS taken
FROM q LEFT JOIN cut ON q.source IS NOT DISTINCT FROM cut.source
""")
def op9_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample(documents(spark, sf_dir)).select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def _fold(modulus: int) -> Column:
    """crc32 of the id as text, modulo."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@register("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.fit(docs.where(_fold(3) != 1))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (_fold(3) == 1).alias("held_out"), "language.lang_pred", "language.score", "language.phrase_chars")


@register("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels").where(_fold(4) != 2))
    return toxicity.score(docs, model).select(
        "doc_id", (_fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(documents(spark, sf_dir))


@register("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edits(documents(spark, sf_dir))


@register("op8_ngram_jaccard")
def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(documents(spark, sf_dir), width=4, percent=85)


@register("op11_permutation_index")
def op11_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir, "embeddings")
    return permutation_index.neighbours(rows, rows.where("vec_id % 20 = 0"))


@register("op12_merkle_manifest", """
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source::VARCHAR) || ':' || source, '-') || coalesce(strlen(lang::VARCHAR) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text,
         list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
           lambda h, b: list_reduce([xor(h, b)] || range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))
         AS inverse FROM documents),
l AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text::VARCHAR) || ':' || text, '-')) AS leaf, CASE WHEN xor(inverse, 4294967295) % 5 = 0 THEN
         sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS other FROM d),
o AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS n FROM l),
nodes AS (
  SELECT 0 AS level, source, place, leaf AS h, n FROM o
  UNION ALL
  SELECT level + 1, source, place // 16, sha256(string_agg(h, '' ORDER BY place)), any_value((n + 15) // 16)
  FROM nodes WHERE n > 1 GROUP BY level, source, place // 16),
s AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
upper AS (
  SELECT 0 AS level, place, subroot AS h, n FROM s
  UNION ALL
  SELECT level + 1, place // 16, sha256(string_agg(h, '' ORDER BY place)), any_value((n + 15) // 16)
  FROM upper WHERE n > 1 GROUP BY level, place // 16),
top AS (SELECT h AS root FROM upper WHERE n = 1),
steps AS (
  SELECT a.level, a.source, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS left_h,
         coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS right_h
  FROM nodes a JOIN nodes b ON a.level = b.level AND a.source IS NOT DISTINCT FROM b.source AND a.place // 16 = b.place // 16
  WHERE a.n > 1 GROUP BY ALL),
upper_steps AS (
  SELECT a.level, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS left_h,
         coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS right_h
  FROM upper a JOIN upper b ON a.level = b.level AND a.place // 16 = b.place // 16
  WHERE a.n > 1 GROUP BY ALL),
lower_fold AS (
  SELECT 0 AS level, source, place AS leaf_place, place, coalesce(other, leaf) AS h, '' AS proof FROM o
  UNION ALL
  SELECT f.level + 1, f.source, f.leaf_place, f.place // 16, sha256(left_h || f.h || right_h), proof || left_h || right_h
  FROM lower_fold f JOIN steps t ON f.level = t.level AND f.source IS NOT DISTINCT FROM t.source AND f.place = t.place),
at_subroot AS (
  SELECT f.source, leaf_place, arg_max(f.h, f.level) AS h, arg_max(f.proof, f.level) AS proof FROM lower_fold f GROUP BY ALL),
upper_fold AS (
  SELECT 0 AS level, a.source, leaf_place, s.place, h, proof FROM at_subroot a JOIN s ON a.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT f.level + 1, f.source, f.leaf_place, f.place // 16, sha256(left_h || f.h || right_h), proof || left_h || right_h
  FROM upper_fold f JOIN upper_steps t ON f.level = t.level AND f.place = t.place),
folded AS (
  SELECT source, leaf_place, arg_max(h, level) AS folded_root, sha256(arg_max(proof, level)) AS proof_sha256 FROM upper_fold GROUP BY ALL)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM o JOIN s ON o.source IS NOT DISTINCT FROM s.source
JOIN folded f ON o.source IS NOT DISTINCT FROM f.source AND o.place = f.leaf_place, top
""")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", merkle.UPPER, merkle.LOWER)
    out = merkle.manifest(documents(spark, sf_dir), changed={"text": lowered}, where=tampered)
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@register("op13_source_divergence", """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM (SELECT *, row_number() OVER () AS row FROM d)),
k AS (SELECT lang, term, count(*) AS total FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
c AS (SELECT o.lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS count,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(s.n, 0) + 2 * v.v) AS p,
         1 + (1000000000::HUGEINT * (k.total + 2)) // (v.n + 2 * v.v) AS q
  FROM g JOIN k ON g.lang = k.lang JOIN v ON g.lang = v.lang LEFT JOIN s ON g.lang = s.lang AND g.source = s.source
  LEFT JOIN c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM p WHERE count > 0 AND p > q),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
""")
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))
