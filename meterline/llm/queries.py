"""The registered queries: each applies its operator with production
parameters to its whole table; ``ORACLE`` has DuckDB SQL where SQL can
express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.llm import (ann, bitsliced, langid, linededup, merkle, mixing, packing, pitman_yor, rtree, simhash, substring,
                           url_filter, warc)
from meterline.llm.common import table
from meterline.session import scratch_path

# The rules of the url query.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring.remove_repeats(table(spark, sf_dir, "documents"), window=20)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"), pitman_yor.held_out(F.col("doc_id")))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_copies=3)
            .select("doc_id", "size", "source_size", "target", "taken"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, lines dropped, and the digest of the kept text (null text as empty)."""
    rows = linededup.drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    out = F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False))
    profiles = langid.learn_profiles(documents.filter(~out))
    return langid.identify(documents, profiles).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rtree.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label, positives=5, negatives=5, low=80, scale=256)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(warc.with_originals(table(spark, sf_dir, "pages"), least=100), path)
    return warc.archived_pages(spark, path)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.verified_manifest(table(spark, sf_dir, "documents"), tampered)


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_substring, op3_packing, op4_ann, op5_lm_score, op6_url_filter, op7_mixing, op8_line_dedup,
    op9_top_k, op10_language_id, op11_hard_negatives, op12_warc, op13_merkle)}



def _merkle_sql(depth: int = 10) -> str:
    """Each of the ``depth`` levels spelled out: up to 8^depth documents a language."""
    def digest(*values: str) -> str:
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v}::VARCHAR)) || ':' || {v}, '-')" for v in values) + ")"

    def tree(n: str, start: str) -> list[str]:
        out = [f"{n}0 AS MATERIALIZED ({start})"]
        for k in range(depth):
            out += [f"{n}r{k} AS MATERIALIZED (SELECT g, i // 8 AS p, list(h ORDER BY i) AS hs, any_value(c) > 1 AS many "
                    f"FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM {n}{k}) GROUP BY g, i // 8)",
                    f"{n}{k + 1} AS MATERIALIZED (SELECT g, p AS i, CASE WHEN many THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {n}r{k})"]
        return out

    def fold(f: str, n: str, start: str) -> list[str]:
        out = [f"{f}0 AS ({start})"]
        for k in range(depth):
            out.append(f"""{f}{k + 1} AS (SELECT doc_id, lang, leaf, f.g, i // 8 AS i,
  CASE WHEN many THEN sha256(array_to_string(hs[1:i % 8], '') || h || array_to_string(hs[i % 8 + 2:], '')) ELSE h END AS h,
  CASE WHEN many THEN s || array_to_string(hs[1:i % 8], '') || array_to_string(hs[i % 8 + 2:], '') ELSE s END AS s
  FROM {f}{k} f JOIN {n}r{k} r ON f.g IS NOT DISTINCT FROM r.g AND i // 8 = p)""")
        return out

    text = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384))))"""
    parts = [
        f"""d AS MATERIALIZED (SELECT doc_id, lang, {digest("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
  CASE WHEN {crc} % 3 = 0 THEN {digest("doc_id", "source", "lang", "n_chars", text)} END AS changed FROM documents)""",
        *tree("n", "SELECT lang AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS i, leaf AS h, "
                   "doc_id, coalesce(changed, leaf) AS now FROM d"),
        *tree("t", f"SELECT '' AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, h, g AS lang FROM n{depth}"),
        *fold("f", "n", "SELECT doc_id, g AS lang, h AS leaf, g, i, now AS h, '' AS s FROM n0"),
        *fold("u", "t", f"SELECT f.doc_id, f.lang, leaf, t.g, t.i, f.h, f.s FROM f{depth} f JOIN t0 t ON f.lang IS NOT DISTINCT FROM t.lang")]
    return "WITH " + ",\n".join(parts) + f"""
SELECT u.doc_id, leaf, t0.h AS subroot, r.h AS root, sha256(s) AS proof_sha256, u.h AS folded_root, u.h = r.h AS verified
FROM u{depth} u JOIN t0 ON u.lang IS NOT DISTINCT FROM t0.lang JOIN t{depth} r ON true"""


ORACLE = {
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND len(embedding) > 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda x: x[1] * x[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
r AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 5""",
    "op12_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
r AS (SELECT *, CASE WHEN n >= 100 THEN nullif(min(page_id) OVER (PARTITION BY h, n), page_id) END AS first FROM d)
SELECT page_id, n AS payload_bytes, h AS payload_digest, CASE WHEN first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  first AS refers_to FROM r""",
    "op13_merkle": _merkle_sql(),
    "op2_substring": r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), CAST([] AS VARCHAR[])) AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20),
g AS (SELECT doc_id, s, sha256(array_to_string(w[s:s + 19], ' ')) AS g FROM p),
r AS (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS n FROM g),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM r WHERE n > 1),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT words.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY words.i) AS t
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i WHERE gone.i IS NULL GROUP BY words.doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id""",
    "op8_line_dedup": r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents WHERE text IS NOT NULL),
t AS (
  SELECT doc_id, line_no, list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'),
    lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS tok FROM l),
k AS (SELECT *, (len(tok), tok[1:3]) AS leaf FROM t WHERE len(tok) > 0),
leaves AS (SELECT leaf FROM k GROUP BY leaf HAVING count(DISTINCT doc_id) >= 3),
c AS (SELECT * FROM k WHERE leaf IN (SELECT leaf FROM leaves)),
v AS (
  SELECT leaf, pos, token, count(*) AS n
  FROM (SELECT leaf, unnest(tok) AS token, unnest(range(len(tok))) AS pos FROM c) GROUP BY leaf, pos, token),
b AS (SELECT leaf, pos, CASE WHEN 2 * max(n) >= sum(n) THEN min((-n, token))[2] END AS token FROM v GROUP BY leaf, pos),
p AS (SELECT leaf, list(token ORDER BY pos) AS template FROM b GROUP BY leaf),
g AS (
  SELECT doc_id, line_no, c.leaf, CASE WHEN
    len(list_filter(list_zip(tok, template), lambda x: coalesce(x[1] = x[2], false))) / len(tok) < 0.8 THEN tok END AS own
  FROM c JOIN p ON c.leaf = p.leaf),
r AS (SELECT leaf, own, min(doc_id) AS first_doc FROM g GROUP BY leaf, own HAVING count(DISTINCT doc_id) >= 3),
gone AS (
  SELECT DISTINCT doc_id, line_no FROM g JOIN r ON g.leaf = r.leaf AND g.own IS NOT DISTINCT FROM r.own
  WHERE doc_id > first_doc),
kept AS (
  SELECT l.doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY l.line_no) AS t
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.line_no = gone.line_no WHERE gone.doc_id IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0) AS n_lines,
  coalesce(len(string_split(text, chr(10))), 0) - coalesce(n, 0) AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id""",
    "op9_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND len(embedding) > 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda x: x[1] * x[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op6_url_filter": r"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(kind, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT page_id, host, path, (SELECT max((length(h || p), h || p, kind)) FROM rules
    WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best FROM parts)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path,
  best[2] AS rule, coalesce(best[3], 'allow') AS verdict FROM fits""",
}
