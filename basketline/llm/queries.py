"""One registered query for each operator: it applies the operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketline.llm import divergence, fingerprints, line_dedup, mixing, near_dups, piece_coding, quality_model
from basketline.llm import quality_rules, secret_scan, spelling, token_counts, topk_search, url_filter
from basketline.llm.tables import table, text_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_pieces(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = piece_coding.encode(docs, vocabulary("piece_bpe_32k.model"))
    return out.select(
        F.col("row.doc_id").alias("doc_id"), F.size("ids").cast("long").alias("n_ids"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == text_of("row.text")).alias("round_trip"),
    )


@query
def op2_urls(spark, sf):
    labelled = spark.createDataFrame(url_filter.LABELLED, "url string, label int")
    return url_filter.judge(table(spark, sf, "pages"), labelled)


@query
def op3_near_dups(spark, sf):
    return near_dups.members(table(spark, sf, "documents"))


@query
def op4_quality_rules(spark, sf):
    return quality_rules.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op5_line_dedup(spark, sf):
    return line_dedup.dedup_lines(table(spark, sf, "documents"))


@query
def op6_secrets(spark, sf):
    return secret_scan.scan(table(spark, sf, "documents"))


@query
def op7_tokens(spark, sf):
    out = token_counts.count_tokens(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op8_quality(spark, sf):
    docs = table(spark, sf, "documents")
    model = quality_model.train(docs, table(spark, sf, "labels"))
    out = quality_model.scored(docs.select("doc_id", "text"), model)
    return out.select(
        F.col("row.doc_id").alias("doc_id"), quality_model.held_out("row.doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op9_mix(spark, sf):
    out = mixing.mix(table(spark, sf, "documents"), keep=["doc_id", "source"])
    return out.select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), F.col("row.source").alias("source"), "rate", "copies",
    )


@query
def op10_fingerprints(spark, sf):
    return fingerprints.compared(table(spark, sf, "documents"))


@query
def op11_top_k(spark, sf):
    return topk_search.top_k(table(spark, sf, "embeddings"))


ORACLE_SQL["op11_top_k"] = """
    WITH whole AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec FROM embeddings
      WHERE vec_id IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
    scores AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.vec, c.vec) AS BIGINT) AS score
      FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, CAST(place AS INT) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scores)
    WHERE place <= 5"""


@query
def op12_spelling(spark, sf):
    return spelling.grouped(table(spark, sf, "documents"))


@query
def op13_divergence(spark, sf):
    return divergence.audit(table(spark, sf, "documents"))


ORACLE_SQL["op13_divergence"] = """
    WITH texts AS (
      SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
      FROM documents),
    found AS (
      SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM texts),
    kept AS (SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
    counts AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL),
    groups AS (SELECT DISTINCT lang, source FROM texts),
    cells AS (
      SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
      FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    rated AS (
      SELECT lang, source, term, n,
        1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER g + 2 * count(*) OVER g) AS p,
        1 + (1000000000::HUGEINT * (lang_n + 2)) // (sum(lang_n) OVER g + 2 * count(*) OVER g) AS q
      FROM cells WINDOW g AS (PARTITION BY lang, source)),
    pairs AS (
      SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
      FROM rated a JOIN rated b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    parts AS (
      SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
      FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
      LEFT JOIN pairs ON pairs.lang = g.lang AND pairs.source = g.source AND pairs.item = h.source
      UNION ALL
      SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM rated WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INT) AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM parts)
    WHERE part = 'pair' OR place <= 10"""
