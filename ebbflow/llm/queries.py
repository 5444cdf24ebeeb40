"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, cover_tree, license_scan, mixing, multi_index, ngram_join, packing, resampling, secret_scan, spelling, token_files, toxicity, url_filter, vectors, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(common.table(spark, sf_dir, "documents"), words=3, p=90, q=100)


#: Statements of licences, by SPDX name.
LICENSES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
#: Whole texts and headers (.header), by SPDX name.
LICENSE_TEXTS = [(p.name.removesuffix(".txt").removesuffix(".header"), p.read_text()) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))]


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as files below source and language. A passage from the first line on is a header, for its file alone; one
    further down, or a text that is a licence as a whole, makes the document a licence file of its directory."""
    docs = common.table(spark, sf_dir, "documents")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    folder = F.when(F.pmod("doc_id", F.lit(10)) == 0, F.lit("")).otherwise(F.concat(F.pmod(F.floor(F.col("doc_id") / 10), F.lit(500)).cast("string"), F.lit("/")))
    path = F.concat(F.coalesce("source", F.lit("none")), F.lit("/"), F.coalesce("lang", F.lit("none")), F.lit("/"), F.coalesce(folder, F.lit("")), name)
    templates = spark.createDataFrame(LICENSES + LICENSE_TEXTS, "license_id string, text string")
    own = license_scan.matched(docs.select("doc_id", path.alias("path"), "text"), templates)
    own = common.stored(own.withColumn("is_license_file", F.coalesce((F.col("line") > 0) | F.col("whole"), F.lit(False))), "own-licences")
    return license_scan.inherited(own).select("doc_id", "path", "license_id", "cosine", "inherited", "from_dir")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return token_files.read(token_files.write(docs, TOKENIZER, common.new_path(spark, "token-files"), end_id=2))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _, pieces = mixing.mix(common.table(spark, sf_dir, "documents"))
    taken = pieces.groupBy("source_no", "start").agg(F.sum("length").alias("taken"))
    with_words = F.when(F.col("size") > 0, F.col("start"))  # others have no place of their own
    joined = rows.withColumn("start", with_words).join(taken, ["source_no", "start"], "left")
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors.cleaned(common.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", zero=False)
    found = multi_index.search(rows, rows.where("id % 100 = 0"), 10)
    return found.withColumnRenamed("id", "vec_id")


def op6_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = common.table(spark, sf_dir, "embeddings")
    rows = vectors.cleaned(embeddings, "vec_id", "embedding", zero=True, map_=lambda x: np.floor(64 * x))
    found = cover_tree.search(rows, rows.where("id % 20 = 0"), 20)
    return found.withColumnRenamed("id", "vec_id")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(common.table(spark, sf_dir, "pages"), common.new_path(spark, "warc"))
    return warc.read(warc.normalised(archives))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, common.table(spark, sf_dir, "labels"), keep_text=False)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(common.table(spark, sf_dir, "documents"), TOKENIZER, end_id=1)


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_filter.judge(common.table(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents of at least 20 words, drawn by how much more often benchmark texts hold their words."""
    docs = common.table(spark, sf_dir, "documents")
    scored = resampling.scored(docs, common.table(spark, sf_dir, "benchmark"), max_n=1, buckets=10_000, keep=["doc_id"])
    found = resampling.drawn(scored, "doc_id", percent=10, min_words=20, seed=2024)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents, one occurrence in 31 with a letter deleted, and the far commoner near word that each may stand for."""
    words = spelling.runs(common.table(spark, sf_dir, "documents"), least=7, typo_every=31).where("n >= 2")
    return spelling.grouped(common.stored(words, "spelling-words"), times=10)


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of documents by pattern, and by likeness in format to them."""
    found = secret_scan.found_secrets(common.table(spark, sf_dir, "documents"), keep=["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    order = F.array(*map(F.lit, secret_scan.KINDS + secret_scan.LIKELY))
    both = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("place"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return found.select("doc_id", *map(count, secret_scan.KINDS), F.sha2(secret_scan.joined(F.col("base")), 256).alias("base_sha256"), secret_scan.joined(both).alias("spans"))


_ALL = (op1_ngram_join, op2_license_scan, op3_token_files, op4_source_mix, op5_nearest, op6_top_products, op7_warc, op8_toxicity, op9_best_fit_packing, op10_url_filter, op11_importance_resampling, op12_spelling_variants, op13_secret_scan)
QUERIES = {f.__name__: f for f in _ALL}

#: crc32 of distinct texts in the table `distinct_texts(v)`: a table of 256 by the polynomial, then byte by byte.
_CRC32 = """
        polynomial(i, k, c) AS (
            SELECT i, 0, CAST(i AS BIGINT) FROM range(256) r(i)
            UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM polynomial WHERE k < 8
        ), crc_table AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM polynomial WHERE k = 8),
        crcs AS MATERIALIZED (
            SELECT v, xor(list_reduce(
                list_prepend(4294967295, list_transform(range(CAST(length(hex(v)) // 2 AS BIGINT)), lambda i: CAST('0x' || substr(hex(v), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
                lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS crc
            FROM distinct_texts, crc_table
        )
"""
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op11_importance_resampling": f"""
        WITH RECURSIVE texts AS (
            SELECT 's' AS side, row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
            UNION ALL SELECT 't', row_number() OVER (), NULL, coalesce(text, '') FROM benchmark
        ), words AS MATERIALIZED (
            SELECT side, r, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS v FROM texts
        ), distinct_texts AS (SELECT DISTINCT v FROM words), {_CRC32}, counted AS (
            SELECT crc % 10000 AS bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM words JOIN crcs USING (v) GROUP BY 1
        ), gains AS (
            SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST(sum(s) OVER () AS DOUBLE) + 10000)
                / ((CAST(s AS DOUBLE) + 1) * (CAST(sum(t) OVER () AS DOUBLE) + 10000)))) AS BIGINT) AS gain
            FROM counted
        ), weights AS (
            SELECT r, count(*) AS n, CAST(sum(gain) AS BIGINT) AS w FROM words JOIN crcs USING (v) JOIN gains ON bucket = crc % 10000 WHERE side = 's' GROUP BY 1
        ), scored AS (
            SELECT r, doc_id, coalesce(n, 0) AS n_features, coalesce(w, 0) AS weight,
                coalesce(w, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || left(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8) AS BIGINT) AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
            FROM texts LEFT JOIN weights USING (r) WHERE side = 's'
        ), ranked AS (
            SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (r)
    """,
    "op6_top_products": """
        WITH clean AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM clean q JOIN clean c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scores QUALIFY rank <= 20
    """,
    "op12_spelling_variants": f"""
        WITH RECURSIVE found AS MATERIALIZED (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS v, w FROM (
                SELECT doc_id, {_LOWER.format("unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+'))")} AS w FROM documents
            ) WHERE length(w) >= 7
        ), distinct_texts AS (SELECT DISTINCT v FROM found), {_CRC32}, written AS (
            SELECT CASE WHEN crc % 31 = 0 THEN left(w, crc % length(w)) || substr(w, crc % length(w) + 2) ELSE w END AS word FROM found JOIN crcs USING (v)
        ), words AS MATERIALIZED (
            SELECT word, count(*) AS n FROM written WHERE length(word) >= 7 GROUP BY 1 HAVING count(*) >= 2
        ), cut AS MATERIALIZED (
            SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)
        ), near AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
        ), best AS (
            SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY 1
        ), forms AS MATERIALIZED (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
            FROM words LEFT JOIN best USING (word)
        ), steps(word, root, form) AS (
            SELECT word, word, form FROM forms UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON f.word = s.form
        )
        SELECT word, f.form, root, n, n_near, form_n FROM forms f JOIN steps s USING (word) WHERE s.form IS NULL
    """,
    "op7_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), g AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS response FROM p
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
            CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> response THEN response END AS refers_to
        FROM g
    """,
    "op10_url_filter": f"""
        WITH rests AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM rests
        ), rules(rule_host, rule_path, rule_verdict) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)})
        SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict
        FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) = 1
    """
}
