"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from stratalode.llm import alignment, credentials, decontaminate, hard_negatives, html_text, language, minhash, mixing, permutation_index, pii, toxicity, url_filters, warc
from stratalode.sinks import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    index = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    found = warc.read_records(index, folder)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), newest AS (
  SELECT payload_digest, max(page_id) AS newest FROM payloads WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN n.newest IS NULL OR p.page_id = n.newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id <> n.newest THEN n.newest END AS refers_to
FROM payloads p LEFT JOIN newest n USING (payload_digest)
"""


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        decontaminate.items_digest().alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP2_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL
), sized AS (
  SELECT *, least(10, len(words)) AS length FROM item_words WHERE len(words) > 0
), grams AS (
  SELECT DISTINCT item_id, length,
         unnest(list_transform(range(1, len(words) - length + 2), lambda i: array_to_string(words[i:i + length - 1], ' '))) AS gram
  FROM sized
), doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents
), doc_windows AS (
  SELECT doc_id, length, unnest(range(1, len(words) - length + 2)) AS pos, words
  FROM doc_words, (SELECT DISTINCT length FROM grams)
), hits AS (
  SELECT w.doc_id, w.pos, w.length, g.item_id
  FROM (SELECT doc_id, pos, length, array_to_string(words[pos:pos + length - 1], ' ') AS gram FROM doc_windows) w
  JOIN grams g ON w.gram = g.gram AND w.length = g.length
), covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + length)) AS word FROM hits) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(l.n_items, 0) AS n_items,
       coalesce(l.digest, sha256('')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered c USING (doc_id) LEFT JOIN listed l USING (doc_id)
"""


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.fit_pii(docs))
    base = F.filter("pii", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.array_remove(F.transform(kinds, lambda s: F.when(s == k, k).otherwise("")), "")).cast("bigint").alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.spans_text(base), 256).alias("base_sha256"), pii.spans_text("pii").alias("spans")
    )


def fold(folds: int):
    """The part of the rows a document belongs to, by its id."""
    return F.crc32(F.col("doc_id").cast("string")) % folds


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    return toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels").where(fold(5) != 0))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit_languages(docs.where(fold(4) != 2))
    found = language.identify_languages(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"),
        F.col("lang_best").alias("lang_pred"),
        F.col("lang_score").alias("score"),
    )


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages).select("page_id", "url", "text", "n_chars")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4)


OP10_SQL = r"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle
  FROM doc_words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), met AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM met JOIN sizes sa ON a = sa.doc_id JOIN sizes sb ON b = sb.doc_id
  WHERE 100 * common >= 80 * (sa.n + sb.n - common)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
), least_of AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN least_of c USING (doc_id)
"""

def op5_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = permutation_index.build_index(vectors)
    return permutation_index.search(index, vectors.where(F.col("vec_id") % 50 == 0))


# The rules that the query is told to apply.
URL_RULES = (
    url_filters.Rule("org", "/", "allow"),
    url_filters.Rule("example.org", "/es/", "block"),
    url_filters.Rule("example.org", "/en/1", "block"),
    url_filters.Rule("com", "/fr/", "allow"),
    url_filters.Rule("com", "/de/", "block"),
)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = url_filters.judge_urls(pages.select("page_id", "url"), URL_RULES, url_filters.hosts_of_links(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = """
WITH parts AS (
  SELECT page_id, coalesce(html, '') AS page,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), urls AS (
  SELECT page_id, length(page) AS chars, (length(page) - length(replace(page, '<a ', ''))) // 3 AS links, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), listed AS (
  SELECT host FROM urls WHERE host <> '' GROUP BY host
  HAVING sum(links) * 100 * (SELECT sum(chars) FROM urls) > sum(chars) * 110 * (SELECT sum(links) FROM urls)
), rules(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'allow'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), best AS (
  SELECT u.page_id, u.host, u.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
         max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM urls u LEFT JOIN rules r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY u.page_id, u.host, u.path
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM best
"""


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':8') AS at
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
            WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sources
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, encode(source) NULLS LAST) AS n FROM weighed
), walked AS (
  SELECT *, (SELECT 3 * sum(source_size) FROM ordered)
            - coalesce(sum(4 * source_size) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remains,
         sum(weight) OVER (ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM ordered
), first_open AS (
  SELECT remains, weights, n FROM walked WHERE remains * weight < 4 * source_size * weights ORDER BY n LIMIT 1
), planned AS (
  SELECT w.source, w.source_size,
         CASE WHEN f.n IS NULL OR w.n < f.n THEN CAST(2 * w.source_size AS DOUBLE)
              ELSE CAST(f.remains * w.weight AS DOUBLE) / CAST(2 * f.weights AS DOUBLE) END AS target
  FROM walked w LEFT JOIN first_open f ON true
), placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, CAST(floor(p.target + 0.5) AS BIGINT) AS quota,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.at, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS start
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(0, least(size, quota - start)) + greatest(0, least(size, quota - source_size - start)) AS BIGINT) AS taken
FROM placed
"""


def op11_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["base"])
    counts = [F.size(F.filter(base, lambda s: s["kind"] == F.lit(k))).cast("bigint").alias(f"n_{k}") for k in credentials.BASE_KINDS]  # noqa: B023
    return found.select(
        "doc_id", *counts, F.sha2(pii.spans_text(base), 256).alias("base_sha256"), pii.spans_text("secrets").alias("spans")
    )


def _found_sql(name: str, pattern: str, group: int, column: str = "text") -> str:
    """SQL for where a pattern is found in documents: (doc_id, n, start, stop, found, value)."""
    quoted = pattern.replace("'", "''")
    return f"""
{name} AS (
  SELECT doc_id, n, found, value, upto - length(found) AS start, upto AS stop FROM (
    SELECT *, CAST(sum(length(ahead) + length(found)) OVER (PARTITION BY doc_id ORDER BY n) AS BIGINT) AS upto FROM (
      SELECT doc_id, unnest(regexp_extract_all({column}, '{quoted}')) AS found,
             unnest(regexp_extract_all({column}, '{quoted}', {group})) AS value,
             unnest(string_split_regex({column}, '{quoted}')[:-2]) AS ahead,
             unnest(range(len(regexp_extract_all({column}, '{quoted}')))) AS n
      FROM docs)))"""


def _role_sql() -> str:
    parts = {k: p.replace("'", "''") for k, p in (("assign", credentials.ASSIGN), ("all", credentials.PARTS))}
    groups = [f"coalesce(regexp_extract(found, '^(?:{parts['all']})$', {g}), '')" for g in range(1, 7)]
    return f"""
CASE WHEN length({groups[0]}) >= {credentials.LEAST_VALUE} THEN 'assign' WHEN {groups[1]} <> '' THEN 'access'
     WHEN {groups[2]} <> '' THEN 'endpoint' WHEN {groups[3]} <> '' THEN 'user' WHEN {groups[4]} <> '' THEN 'hex'
     WHEN regexp_matches({groups[5]}, '{credentials.ACCESS}|{credentials.HEX}')
     THEN CASE WHEN regexp_matches({groups[5]}, '{credentials.HEX}') THEN 'held_hex' ELSE 'held_access' END
     WHEN regexp_matches({groups[5]}, '{credentials.DIGITS}') AND regexp_matches({groups[5]}, '{credentials.LETTERS}') THEN 'key'
     ELSE '' END"""


OP11_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{_found_sql("assigns", credentials.ASSIGN, 1)}, {_found_sql("accesses", credentials.ACCESS, 0)}, {_found_sql("hexes", credentials.HEX, 0)},
{_found_sql("parts", credentials.PARTS, 0)}, {_found_sql("breaks", credentials.SCOPE_END, 0)},
base AS (
  SELECT doc_id, 'assign' AS kind, 0 AS rank, start, stop FROM assigns WHERE length(value) >= {credentials.LEAST_VALUE}
  UNION ALL SELECT doc_id, 'access', 1, start, stop FROM accesses
  UNION ALL SELECT doc_id, 'hex', 2, start, stop FROM hexes
), roles AS (
  SELECT p.doc_id, p.start, p.stop, {_role_sql()} AS role,
         (SELECT count(*) FROM breaks b WHERE b.doc_id = p.doc_id AND b.start < p.start) AS scope
  FROM parts p
), met AS (
  SELECT w.doc_id, w.start, w.stop, w.role, list(q.role) AS near
  FROM roles w JOIN roles q ON w.doc_id = q.doc_id AND w.scope = q.scope
   AND q.start - w.stop <= {credentials.REACH} AND w.start - q.stop <= {credentials.REACH}
  WHERE w.role IN ('user', 'key', 'endpoint') GROUP BY ALL
), told AS (
  SELECT *, list_has_any(near, ['access', 'held_access']) AS identifier, list_has_any(near, ['assign', 'hex', 'held_hex']) AS secret,
         list_contains(near, 'user') AS user_near, list_contains(near, 'key') AS key_near, list_contains(near, 'endpoint') AS endpoint_near
  FROM met
), linked AS (
  SELECT doc_id, role AS kind, CASE role WHEN 'user' THEN 3 WHEN 'key' THEN 4 ELSE 5 END AS rank, start, stop FROM told
  WHERE (role = 'key' AND (identifier OR (user_near AND endpoint_near)))
     OR (role = 'user' AND (secret OR (key_near AND endpoint_near)))
     OR (role = 'endpoint' AND (identifier OR user_near) AND (secret OR key_near))
), listed AS (
  SELECT doc_id, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM (FROM base UNION ALL FROM linked) GROUP BY doc_id
), digests AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, sha256(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)) AS digest
  FROM base GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(digest, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN digests USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = alignment.align_tokens(docs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", alignment.groups_digest().alias("groups_sha256"), "link_a", "link_b", "link_n"
    )
    counted = alignment.with_counts(alignment.staged_alignment(aligned))
    return counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine_hard_negatives(vectors, vectors.where(F.col("vec_id") % 50 == 0))


OP13_SQL = """
WITH taking_part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS whole
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.whole, b.whole) AS BIGINT) AS score
  FROM taking_part a JOIN taking_part b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 3
"""


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_decontamination": op2_decontamination,
    "op6_url_filters": op6_url_filters,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_permutation_index": op5_permutation_index,
    "op7_language": op7_language,
    "op8_mixing": op8_mixing,
    "op9_html_text": op9_html_text,
    "op10_minhash": op10_minhash,
    "op11_credentials": op11_credentials,
    "op12_alignment": op12_alignment,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {"op1_warc": OP1_SQL, "op2_decontamination": OP2_SQL, "op10_minhash": OP10_SQL, "op6_url_filters": OP6_SQL, "op8_mixing": OP8_SQL, "op11_credentials": OP11_SQL, "op13_hard_negatives": OP13_SQL}


def importable(query: Query) -> Query:
    """The query, run with Python workers that find this package wherever the driver was started."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = str(Path(__file__).resolve().parents[2])
        environment = spark.sparkContext.environment
        if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
            environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, environment.get("PYTHONPATH")]))
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: importable(query) for name, query in QUERIES.items()}


def oracles() -> dict[str, str]:
    return dict(ORACLES)
