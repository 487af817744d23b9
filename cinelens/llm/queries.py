"""Registered queries of this subpackage and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import (decontaminate, html_text, language, merkle, near_dedup, packing, passages, range_join, substring_sort, token_counts,
               url_filter, warc, whitening)

#: Rules of op8: (verdict, host, path).
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(read_table(spark, sf_dir, "documents")).drop("h")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.apply_rules(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_sort.repeated_substrings(read_table(spark, sf_dir, "documents")).drop("starts", "ends")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_join.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read_table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"))


def merkle_sql(levels: int = 8) -> str:
    """DuckDB SQL of op12 for trees of up to 16 ** levels leaves: one step per level, for the sources and again for the root."""
    def field(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"

    def climb(tag: str) -> list[str]:
        """CTEs {tag}0..{tag}N of (g, i, h, n): nodes per level; {tag}s: siblings of every node that has a parent."""
        ctes = []
        for k in range(levels):
            at = f"{tag}{k}"
            ctes.append(f"""{at}s AS (SELECT g, i, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
  coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS z FROM {at} WHERE n > 1 WINDOW w AS (PARTITION BY g, i // 16 ORDER BY i))""")
            ctes.append(f"""{tag}{k + 1} AS (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS n FROM (
  SELECT g, i // 16 AS i, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE max(h) END AS h FROM {at} GROUP BY g, i // 16))""")
        return ctes

    def fold(tag: str, start: str, name: str) -> list[str]:
        """CTEs that take proof and folded hash one level up at a time."""
        ctes = [f"{name}0 AS ({start})"]
        for k in range(levels):
            ctes.append(f"""{name}{k + 1} AS (SELECT p.* REPLACE (p.proof || coalesce(s.a || s.z, '') AS proof,
  CASE WHEN s.g IS NULL THEN p.fold ELSE sha256(s.a || p.fold || s.z) END AS fold) FROM {name}{k} p LEFT JOIN {tag}{k}s s ON s.g = p.g AND s.i = p.i // {16 ** k})""")
        return ctes

    plain = " || ".join(field(c) for c in merkle.COLUMNS)
    tampered = plain.replace(field("text"), field(f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')"))
    crc = ("list_reduce([4294967295::UBIGINT::HUGEINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
           "lambda d: [ascii(d)::HUGEINT, -1, -1, -1, -1, -1, -1, -1, -1])), "
           "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)")
    ctes = [
        f"""leaf AS (SELECT doc_id, source, sha256({plain}) AS leaf,
  CASE WHEN xor({crc}, 4294967295) % 5 = 0 THEN sha256({tampered}) END AS other FROM documents)""",
        """d AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaf)""",
        "s0 AS (SELECT g, i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM d)", *climb("s"),
        f"r0 AS (SELECT 0 AS g, g AS i, h, count(*) OVER () AS n FROM s{levels})", *climb("r"),
        *fold("s", "SELECT doc_id, leaf, g, i, '' AS proof, coalesce(other, leaf) AS fold FROM d", "f"),
        *fold("r", f"SELECT doc_id, leaf, 0 AS g, g AS i, proof, fold FROM f{levels}", "u"),
    ]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT u.doc_id, u.leaf, s.h AS subroot, r.h AS root, sha256(u.proof) AS proof_sha256, u.fold AS folded_root, u.fold = r.h AS verified
FROM u{levels} u JOIN s{levels} s ON s.g = u.i CROSS JOIN r{levels} r"""


QUERIES = {
    "op3_language_id": op3_language_id,
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_near_dedup": op2_near_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_packing": op5_packing,
    "op6_html_text": op6_html_text,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_warc": op9_warc,
    "op10_range_join": op10_range_join,
    "op11_whitening": op11_whitening,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_counts": op13_token_counts,
}

ORACLE = {
    "op12_merkle_manifest": merkle_sql(),
    "op9_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS lead FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
  CASE WHEN f.lead IS NULL OR f.lead = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.lead <> d.page_id THEN f.lead END AS refers_to
FROM d LEFT JOIN f ON f.payload_digest = d.payload_digest AND d.payload_bytes >= 100""",
    "op8_url_filter": """
WITH rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT row_number() OVER () AS i, page_id,
  translate(regexp_extract(coalesce(r, ''), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (SELECT p.i, r.verdict, r.host || r.path AS rule,
  row_number() OVER (PARTITION BY p.i ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.i = p.i AND f.k = 1""",
}
