"""Registered queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoindicators.llm.common import ship_package
from geoindicators.llm.exact_dedup import exact_dedup
from geoindicators.llm.hard_negatives import mine_hard_negatives
from geoindicators.llm.html_wrapper import extract_main_text
from geoindicators.llm.langid import identify_language, train_language_model
from geoindicators.llm.minhash_dedup import near_dedup
from geoindicators.llm.packing import pack_documents
from geoindicators.llm.paragraph_dedup import repeated_passages
from geoindicators.llm.pii import find_pii, train_pii_model
from geoindicators.llm.tiling import contaminated
from geoindicators.llm.toxicity import score_toxicity, train_toxicity_model
from geoindicators.llm.url_filter import judge_urls
from geoindicators.llm.vector_codes import compress
from geoindicators.llm.warc import read_warc, write_warc

#: Fixed rules (host, path, verdict) of the url query.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup(_read(spark, sf, "documents"))


def op2_html_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return extract_main_text(_read(spark, sf, "pages"))


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents")
    return score_toxicity(docs, train_toxicity_model(docs, _read(spark, sf, "labels")))


def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder, manifest = write_warc(_read(spark, sf, "pages"))
    return read_warc(folder, manifest).drop("url")


def op5_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(_read(spark, sf, "documents"))


def op6_paragraph_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_passages(_read(spark, sf, "documents"))


def op7_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(_read(spark, sf, "pages"), rules)


def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(_read(spark, sf, "documents"), _read(spark, sf, "benchmark"))


def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents")
    return identify_language(docs, train_language_model(docs))


def op10_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup(_read(spark, sf, "documents"))


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(_read(spark, sf, "embeddings").withColumn("label", label), F.col("vec_id") % 50 == 0)


def op12_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents")
    return find_pii(docs, train_pii_model(docs)).drop("redacted")


def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return compress(_read(spark, sf, "embeddings"))[0].drop("label")


Q = {"op1_exact_dedup": op1_exact_dedup, "op2_html_main_text": op2_html_main_text, "op3_toxicity": op3_toxicity, "op4_warc": op4_warc, "op5_best_fit_packing": op5_best_fit_packing,
     "op6_paragraph_dedup": op6_paragraph_dedup, "op7_url_filter": op7_url_filter, "op8_decontamination": op8_decontamination,
     "op9_language_id": op9_language_id, "op10_minhash_near_dedup": op10_minhash_near_dedup,
     "op11_hard_negatives": op11_hard_negatives, "op12_pii": op12_pii, "op13_vector_codes": op13_vector_codes}

def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """K-means per part in integers, a pair of common tables a round."""
    ctes = [f"""e AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * x::DOUBLE) AS BIGINT)) AS q FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""v AS MATERIALIZED (SELECT vec_id, (i - 1) // (len(q) // {parts}) AS part, (i - 1) % (len(q) // {parts}) AS pos, q[i] AS x
            FROM (SELECT vec_id, q, unnest(range(1, len(q) + 1)) AS i FROM e))""",
            f"""c0 AS MATERIALIZED (SELECT part, k AS entry, pos, x FROM v JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM e
            ORDER BY vec_id LIMIT {entries}) USING (vec_id))"""]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, part, entry, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) AS k
            FROM (SELECT vec_id, v.part, entry, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{r} c ON v.part = c.part AND v.pos = c.pos
                  GROUP BY vec_id, v.part, entry)) WHERE k = 1)""")
        if r < rounds:
            ctes.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.part, c.entry, c.pos, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN
                (SELECT part, entry, pos, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM v JOIN a{r} USING (vec_id, part)
                 GROUP BY part, entry, pos) m ON m.part = c.part AND m.entry = c.entry AND m.pos = c.pos)""")
    return f"""WITH {", ".join(ctes)},
        f AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c{rounds}) AS codebooks_sha256
        FROM f JOIN e USING (vec_id)"""


SQL = {
    "op1_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)""",
    "op4_warc": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
             q AS (SELECT page_id, octet_length(encode(t)) AS n, sha1(t) AS d, max(page_id) OVER (PARTITION BY t) AS m FROM p)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 1000 AND m <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND m <> page_id THEN m END AS refers_to
        FROM q""",
    "op7_url_filter": r"""
        WITH u AS (SELECT page_id,
                     translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
             r(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
                     ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
             m AS (SELECT page_id, host, path, rh || rp AS rule, v,
                     row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS k
                   FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
        SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.v, 'allow') AS verdict
        FROM u LEFT JOIN m ON m.page_id = u.page_id AND m.k = 1""",
    "op11_hard_negatives": """
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                     list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS s
                   FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
             p AS (SELECT * FROM (SELECT a, b, s, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS k FROM s WHERE same) WHERE k <= 5),
             n AS (SELECT p.a, p.b, p.s AS ps, s.b AS nb, s.s AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) AS k
                   FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.s <= 100 * s.s AND 100 * s.s <= 95 * p.s)
        SELECT a AS anchor_id, b AS positive_id, CAST(k AS INTEGER) AS rank, nb AS negative_id, ps AS positive_score, ns AS negative_score
        FROM n WHERE k <= 3""",
    "op13_vector_codes": _codes_sql(),
}
