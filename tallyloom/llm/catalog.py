"""The operators of this package as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.bytebpe import decode_documents, encode_documents, ids_text
from tallyloom.llm.common import NO_ID
from tallyloom.llm.infill import fill_in_middle, restored
from tallyloom.llm.lm import lm_scores
from tallyloom.llm.merkle import document_fingerprints
from tallyloom.llm.mixing import label_quality, mix
from tallyloom.llm.packing import pack_documents
from tallyloom.llm.simhash import simhash_groups
from tallyloom.llm.spelling import spelling_variants, word_counts
from tallyloom.llm.substring import substring_dedup
from tallyloom.llm.tokens import read_tokens, write_tokens
from tallyloom.llm.toxicity import toxicity
from tallyloom.llm.vectors import vector_links
from tallyloom.llm.warc import read_pages, write_pages

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup(table(spark, sf, "documents"))


ORACLE["op1_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, array_to_string(w[i : i + 49], ' ') AS window_text, i
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)
), f AS (
  SELECT window_text, min(doc_id) AS first_id FROM s GROUP BY window_text HAVING min(doc_id) < max(doc_id)
), r AS (
  SELECT DISTINCT doc_id, i FROM s JOIN f USING (window_text) WHERE doc_id > first_id
), p AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
), m AS (
  SELECT p.doc_id, p.i, p.word, max(CASE WHEN r.i IS NULL THEN 0 ELSE 1 END)
    OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM p LEFT JOIN r ON p.doc_id = r.doc_id AND p.i = r.i
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(sum(gone), 0)::BIGINT AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '')) AS kept_sha256
FROM d LEFT JOIN m ON d.doc_id = m.doc_id GROUP BY d.doc_id, len(d.w)
"""


@query
def op2_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return lm_scores(table(spark, sf, "documents"))


@query
def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op4_vector_links(spark: SparkSession, sf: str) -> DataFrame:
    return vector_links(table(spark, sf, "embeddings"))


ORACLE["op4_vector_links"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), r AS (
  SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.c = l.a
), n AS (
  SELECT a, count(*) AS n FROM l GROUP BY a
)
SELECT r.vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(c) AS component_id,
       r.vec_id = min(c) AS kept
FROM r LEFT JOIN n ON r.vec_id = n.a GROUP BY r.vec_id
"""


@query
def op5_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix(table(spark, sf, "documents"), label_quality(table(spark, sf, "labels"))).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


ORACLE["op5_source_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         -ln((('0x' || substr(md5(doc_id::VARCHAR || '|42'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
           / coalesce(q, 1.0) AS key
  FROM documents LEFT JOIN (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 2.0 ELSE 0.5 END)::DOUBLE AS q
    FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) USING (doc_id)
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM d GROUP BY source
), r AS (
  SELECT *, 2.0 * source_size / w AS ratio,
         1.5 * sum(source_size) OVER () AS total,
         sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / w, source) AS full_sum,
         sum(w) OVER () - sum(w) OVER (ORDER BY 2.0 * source_size / w, source) AS open_w,
         lead(2.0 * source_size / w) OVER (ORDER BY 2.0 * source_size / w, source) AS next_ratio
  FROM s
), l AS (
  SELECT min(level) AS level FROM (
    SELECT (total - full_sum) / open_w AS level, ratio, next_ratio FROM r WHERE open_w > 0
    UNION ALL SELECT max(total) / sum(w), NULL, min(ratio) FROM r)
  WHERE (ratio IS NULL OR level >= ratio) AND level < next_ratio
), t AS (
  SELECT source, source_size, least(2.0 * source_size, level * w) AS target FROM r, l
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t
), o AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs,
         floor(e.target - e.epochs * e.source_size)::BIGINT
           - (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size) AS room
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, room)))::BIGINT AS taken
FROM o
"""


@query
def op6_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    copies = simhash_groups(docs).groupBy("doc_id").agg(F.coalesce(F.min("component_id"), F.lit(NO_ID)).alias("cluster"))
    return pack_documents(docs, clusters=copies)


@query
def op7_document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return document_fingerprints(table(spark, sf, "documents"))


@query
def op8_warc_pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_pages(write_pages(table(spark, sf, "pages"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE["op8_warc_pages"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS n FROM pages
), m AS (
  SELECT html, max(page_id) AS last_id FROM p WHERE n >= 1000 GROUP BY html
)
SELECT page_id, n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last_id THEN last_id END AS refers_to
FROM p LEFT JOIN m ON p.html = m.html AND n >= 1000
"""


@query
def op9_simhash_groups(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_groups(table(spark, sf, "documents"))


@query
def op10_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return read_tokens(write_tokens(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json")))


@query
def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(word_counts(table(spark, sf, "documents"), spoil=31))


@query
def op12_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = decode_documents(encode_documents(table(spark, sf, "documents"), ranks), ranks)
    return decoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(ids_text().cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op13_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf, "documents"))
    text = restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(text.cast("binary"), 256).alias("restored_sha256"),
    )


ORACLE["op13_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h FROM documents
), l AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
         [('0x' || substr(h, 8 * i + 1, 8))::BIGINT FOR i IN range(4)] AS h FROM d
), c AS (
  SELECT *, len(u)::BIGINT AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
         greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100
           THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l
), p AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(u[b + 1:n], ''), '') AS s FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
