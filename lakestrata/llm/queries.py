"""Registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import scratch_path
from . import chat, clusters, decontaminate, indexed, licenses, minhash, negatives, packing, tokens, topk, toxicity, urls, warc
from .store import ready

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"), RULES)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), size=2)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    folder = warc.write_warc(pages, scratch_path(spark, "warc"))
    found = warc.read_warc(spark, folder)
    return found.where("kind <> 'gap'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = chat.format_chats(rows).select(
        "conv_id", "formatted", chat.parsed(F.col("formatted")).alias("turns"), chat.trained_text(F.col("segments")).alias("loss")
    )
    lines = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _sha(lines).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        _sha(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.k_means(_table(spark, sf_dir, "embeddings"))


def op13_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "token-index")
    indexed.write_index(docs, public_tokenizers.path(BYTE_VOCABULARY), folder)
    return indexed.fetch(spark, folder, docs.select("doc_id"), nulls=True).select("doc_id", "start", "n_tokens", "ids_crc32")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_packing, op3_license_scan, op4_exact_top_k, op5_minhash_dedup, op6_warc,
        op7_chat_format, op8_token_counts, op9_toxicity, op10_decontamination, op11_hard_negatives,
        op12_centroid_clusters, op13_token_index, pipeline,
    )
}

_A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_OP1 = rf"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT row_number() OVER () AS n, page_id, translate(regexp_extract(r, '^[^/?#]*'), {_A_Z}) AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), rules(rule, host, path, verdict) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
         ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
)
SELECT p.page_id, p.host, p.path, r.rule, coalesce(r.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
QUALIFY row_number() OVER (PARTITION BY p.n ORDER BY length(r.rule) DESC NULLS LAST) = 1
"""

_OP4 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.x, d.x)::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

_OP5 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {_A_Z}), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN words ELSE
    list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS shingles
  FROM w
), e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), named AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN named USING (doc_id)
"""

_OP6 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages
), d AS (
  SELECT page_id, octet_length(html::BLOB) AS n, sha, unhex(sha)::BIT::VARCHAR AS bits, min(page_id) OVER (PARTITION BY sha) AS first
  FROM (SELECT page_id, encode(html) AS html, sha FROM p)
)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
    + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
    + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""


_OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same, list_dot_product(a.x, d.x)::BIGINT AS score
  FROM v a JOIN v d ON a.vec_id % 50 = 0 AND a.vec_id <> d.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
QUALIFY rank <= 3
"""


def _op12(k: int = 8, rounds: int = 10) -> str:
    """A table of component sums for each round; ``floor`` on exact DECIMALs, since whole-number division cuts towards zero."""
    parts = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), e AS MATERIALIZED (SELECT n, unnest(range(1, 65)) AS place, unnest(x) AS c FROM v
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS cluster, x FROM v QUALIFY cluster < {k}
)"""]  # fmt: skip
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT n, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
    SELECT n, cluster, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{r} c
  ) GROUP BY n
)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT o.cluster, coalesce(m.x, o.x) AS x FROM c{r} o LEFT JOIN (
    SELECT cluster, list(mean ORDER BY place) AS x FROM (
      SELECT cluster, place, ((sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS mean
      FROM e JOIN a{r} USING (n) GROUP BY cluster, place
    ) GROUP BY cluster
  ) m USING (cluster)
)""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, a.cluster::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (n) JOIN c{rounds} c ON a.cluster = c.cluster
"""


def _escapes(text: str) -> str:
    """SQL for the number of backslashes that escaping adds to a text."""
    marks = ["\\", "<|", "<s>", "</s>", "[INST]", "[/INST]"]
    return " + ".join(f"(length({text}) - length(replace({text}, '{m}', ''))) // {len(m)}" for m in marks)


_OP7 = f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), t AS (
  SELECT *, coalesce(role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), false) AS goes_on FROM r
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN goes_on THEN {len(chat.SPLIT)} ELSE {len(chat.START) + 1 + len(chat.END) + 1} + length(role) + {_escapes('role')} END
      + length(text) + {_escapes('text')})::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

ORACLES: dict[str, str] = {
    "op1_url_filter": _OP1,
    "op4_exact_top_k": _OP4,
    "op5_minhash_dedup": _OP5,
    "op6_warc": _OP6,
    "op7_chat_format": _OP7,
    "op11_hard_negatives": _OP11,
    "op12_centroid_clusters": _op12(),
}
