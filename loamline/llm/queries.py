"""One query for each corpus operator, over its whole table, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, langid, licenses, media, mixing, neardup, secrets_scan, tokenfiles, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op2_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=3, num=85, den=100)


def op3_containment_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op5_language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources stand for hosts; lang is the label of the models' sample, so what a text declares is in its own markup."""
    return langid.identify(table(spark, sf_dir, "documents"))


def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over raw pages: declared by markup, hosts and suffixes from their addresses, text models from documents."""
    model = langid.fit(table(spark, sf_dir, "documents"))
    return langid.identify(table(spark, sf_dir, "pages"), "page_id", "html", "url", None, model=model)


def op6_arrow_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenfiles.token_output(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op7_prefix_tree_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.format_chats(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)).drop("n_packed")


def op8_automaton_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_scan.secrets(table(spark, sf_dir, "documents"))
    n = {name: F.get("counts", F.lit(i)) for i, name in enumerate(("n_assign", "n_access", "n_hex", "n_private_key", "n_jwt"))}
    return found.select("doc_id", *(c.alias(name) for name, c in n.items()), "base_sha256", "spans")


def op9_iso_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.texts_as_media(table(spark, sf_dir, "documents"))


def op10_splittable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "valid")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_patience_licenses": op1_patience_licenses,
    "op2_minmax_near_dedup": op2_minmax_near_dedup,
    "op3_containment_decontamination": op3_containment_decontamination,
    "op4_temperature_mixing": op4_temperature_mixing,
    "op5_language_evidence": op5_language_evidence,
    "language_of_pages": language_of_pages,
    "op6_arrow_token_files": op6_arrow_token_files,
    "op7_prefix_tree_chat": op7_prefix_tree_chat,
    "op8_automaton_secrets": op8_automaton_secrets,
    "op9_iso_media": op9_iso_media,
    "op10_splittable_warc": op10_splittable_warc,
}

#: Words as the operators take them: lower-cased A-Z, runs of anything but space and \\t..\\r.
SHINGLES = """
  SELECT {id} AS id, w, len(w) AS n FROM (SELECT {id}, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM {table} WHERE text IS NOT NULL)
"""

OP3 = f"""
WITH d AS ({SHINGLES.format(id="doc_id", table="documents")}), b AS ({SHINGLES.format(id="item_id", table="benchmark")}),
ds AS (SELECT DISTINCT id, s FROM (SELECT id, unnest(CASE WHEN n = 0 THEN [] WHEN n < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, n - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM d)),
bs AS (SELECT DISTINCT id, s FROM (SELECT id, unnest(CASE WHEN n = 0 THEN [] WHEN n < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, n - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM b)),
bn AS (SELECT id, count(*) AS n_item FROM bs GROUP BY id)
SELECT ds.id AS doc_id, bs.id AS item_id, max(n_item) AS n_item, count(*) AS n_shared
FROM ds JOIN bs ON ds.s = bs.s JOIN bn ON bn.id = bs.id GROUP BY 1, 2 HAVING 5 * count(*) >= 4 * max(n_item)
"""

OP2 = f"""
WITH RECURSIVE d AS ({SHINGLES.format(id="doc_id", table="documents")}),
s AS (SELECT DISTINCT id, s FROM (SELECT id, unnest(CASE WHEN n = 0 THEN [] WHEN n < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, n - 1), lambda i: array_to_string(w[i:i+2], ' ')) END) AS s FROM d)),
n AS (SELECT id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.id AS a, b.id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.id <> b.id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS node, doc_id AS hop FROM documents UNION SELECT node, b FROM reach JOIN l ON a = hop)
SELECT node AS doc_id, coalesce(max(n), 0) AS n_shingles, min(hop) AS component_id, node = min(hop) AS kept FROM reach LEFT JOIN n ON n.id = node GROUP BY node
"""

OP4 = f"""
WITH RECURSIVE d AS ({SHINGLES.format(id="doc_id", table="documents")}),
r AS (SELECT doc_id, coalesce(source, '') AS source, n AS tokens FROM documents JOIN d ON id = doc_id WHERE n > 0),
s AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS t FROM r GROUP BY 1), v AS (SELECT list(CAST(t AS DOUBLE)) AS ts, CAST(max(t) AS DOUBLE) AS top, CAST(min(t) AS DOUBLE) AS low FROM s),
bis AS (SELECT 0 AS k, CAST(0 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi UNION ALL
  SELECT k + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END FROM (
    SELECT k, lo, hi, mid, h <= 0.93 * ln(len(ts)) + 1e-12 AND pow(low / top, mid - 1) <= 2 * (1 + 1e-12) AS ok FROM (
      SELECT *, ln(list_sum(w)) - list_sum(list_transform(w, lambda x: x * ln(x))) / list_sum(w) AS h FROM (
        SELECT k, lo, hi, (lo + hi) / 2 AS mid, ts, top, low, list_transform(ts, lambda x: pow(x / top, (lo + hi) / 2)) AS w FROM bis, v WHERE k < 36)))),
e AS (SELECT least(1.0, CASE WHEN ln(len(ts)) <= 0.93 * ln(len(ts)) + 1e-12 AND top / low <= 2 * (1 + 1e-12) THEN 0.0 ELSE ceil(hi * 1e6) / 1e6 END) AS e, ts, top FROM bis, v WHERE k = 36),
g AS (SELECT e, list_sum(list_transform(ts, lambda x: pow(x, e))) AS total, top FROM e), b AS (SELECT *, pow(top, 1 - e) * total AS whole, greatest(1, CAST(ceil(floor(pow(top, 1 - e) * total) / 1000000) AS BIGINT)) AS blocks FROM g),
q AS (SELECT source, t, CAST(round(pow(CAST(t AS DOUBLE), e) / total * whole) AS BIGINT) AS quota, blocks FROM s, b),
x AS (SELECT doc_id, r.source, tokens, t, quota, blocks, unnest(range(0, greatest(1, CAST(ceil(quota / t) AS BIGINT)))) AS epoch FROM r JOIN q ON q.source = r.source WHERE quota > 0),
o AS (SELECT *, epoch * t + CAST(sum(tokens) OVER (PARTITION BY source, epoch ORDER BY md5(concat('42:', epoch, ':', doc_id)), doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fin FROM x),
k AS (SELECT *, least(CAST(floor((fin - tokens) * CAST(blocks AS DOUBLE) / quota) AS BIGINT), blocks - 1) AS block FROM o WHERE fin <= quota)
SELECT block, row_number() OVER (PARTITION BY block ORDER BY md5(concat('block 42:', source, ':', epoch, ':', doc_id)), source, epoch, doc_id, tokens) AS place, doc_id, source, epoch, tokens FROM k
"""

ESCAPED = "length(replace(replace({0}, '&', '&amp;'), '<|', '&lt;|'))"
SAID = "'<|im_end|><|im_start|>assistant ok'"
OP7 = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-1, 0, 'user', {SAID}), (-1, 1, 'assistant', {SAID}))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(24 + {ESCAPED.format("role")} + {ESCAPED.format("text")}) AS BIGINT) AS formatted_chars FROM c GROUP BY conv_id
"""

#: Five hexadecimal digits are four signs of base 32.
BASE32 = """array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[CAST((CAST(concat('0x', sha1({0})[5 * (i // 4) + 1:5 * (i // 4) + 5]) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT) + 1]), '')"""
OP10 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {BASE32.format("html")} AS payload_digest, CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < top THEN top END AS refers_to, true AS valid FROM m
"""

ORACLES: dict[str, str] = {
    "op2_minmax_near_dedup": OP2,
    "op4_temperature_mixing": OP4,
    "op7_prefix_tree_chat": OP7,
    "op10_splittable_warc": OP10,
    "op3_containment_decontamination": OP3,
}
