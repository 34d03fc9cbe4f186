"""The registered corpus queries, each over its whole table with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import (
    collocations, hard_negatives, licences, mixing, near_dup, packing, passages, prefix_hash, quality, rans, simhash,
    templates, warc)
from salesloom.llm.store import ship, table, work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def tokenizer_file() -> str:
    """Place of the public tokenizer that the queries use; the operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build
    return register


@query("op9_quality_rules", quality.figures_sql())
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.assess(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                       "n_repeat_words", "base_failed", "kept")


@query("op6_rans_tokens")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    back = rans.round_trip(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_file())
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op5_best_fit_packing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_file())


@query("op2_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
t AS (SELECT html, max(page_id) AS top FROM p WHERE strlen(html) >= 1000 GROUP BY html)
SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to
FROM p LEFT JOIN t USING (html)""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    archives = work_folder(spark, "warc")
    found = warc.read(spark, warc.write(table(spark, folder, "pages"), archives), archives)
    response = F.col("record_type") == "response"
    return found.select(
        "page_id", F.when(response, F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("long")
        .alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type", "refers_to")


@query("op7_prefix_fingerprints")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_hash.fingerprints(table(spark, folder, "documents").select("doc_id", "text"))


@query("op4_minhash_near_dedup", """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws)))) AS i FROM w WHERE len(ws) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
b AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id
  GROUP BY 1, 2),
e AS (SELECT a, b FROM b JOIN c p ON p.doc_id = a JOIN c q ON q.doc_id = b
  WHERE 100 * common >= 80 * (p.n + q.n - common)),
r AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.seen),
m AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m USING (doc_id) LEFT JOIN c USING (doc_id)""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query("op8_log_template_lines")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    out = templates.assess(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length("clean_text").cast("long").alias("n_chars_left"),
                      F.sha2("clean_text", 256).alias("clean_sha256"))


@query("op1_mixing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.assess(table(spark, folder, "documents").select("doc_id", "text", "source"))


@query("op10_licence_scan")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents").select("doc_id", "text"))


@query("op3_passage_quality")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return passages.score(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"))


@query("op13_simhash_near_dedup")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query("op12_hard_negatives", """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INT)
    AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 3""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(table(spark, folder, "embeddings"))


@query("op11_collocations", """
WITH w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
t AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS (SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, k, count(*) AS f
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k))
  GROUP BY 1, 2, 3 HAVING count(*) >= 100),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
d AS (SELECT DISTINCT s.lang, s.phrase FROM (SELECT lang, a, k, ws, m, unnest(range(1, k - m + 2)) AS i
    FROM c, (SELECT unnest(range(2, 5)) AS m) WHERE m < k) q
  JOIN c s ON s.lang = q.lang AND s.phrase = array_to_string(q.ws[q.i:q.i + q.m - 1], ' ') AND 100 * q.a >= 100 * s.a),
s AS (SELECT c.lang, c.phrase, c.a, l.f AS l, r.f AS r, t.n,
    CAST(CAST(1000 AS HUGEINT) * c.a * t.n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score, c.j
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN t USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[j + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM s ANTI JOIN d USING (lang, phrase) QUALIFY rank <= 2000""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(table(spark, folder, "documents").select("text", "lang"))
