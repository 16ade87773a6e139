"""The registered queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glosswork.llm.ann import nearest
from glosswork.llm.decontam import leaks
from glosswork.llm.htmltext import extract_text
from glosswork.llm.langid import identify
from glosswork.llm.linededup import dedup_lines
from glosswork.llm.mixing import mix_plan
from glosswork.llm.ngramjoin import ngram_components
from glosswork.llm.secrets import BASE_RULES, find_secrets, span_list
from glosswork.llm.secrets import RULES as RULES_OF_SECRETS
from glosswork.llm.toxicity import fit, score_toxicity
from glosswork.llm.urls import RULES, judge_urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), words=4, num=85, den=100).select("doc_id", "n_shingles", "component_id")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge_urls(table(spark, sf_dir, "pages"))
    return out.select("page_id", F.col("_url_host").alias("host"), F.col("_url_path").alias("path"), F.col("_url_rule").alias("rule"), F.col("_url_verdict").alias("verdict"))


def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"), output="text")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_ld_n_lines").alias("n_lines"), F.col("_ld_n_dropped").alias("n_dropped"), F.sha2(F.coalesce("_ld_kept", F.lit("")), 256).alias("kept_sha256"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", F.col("_mix_size").alias("size"), F.col("_mix_total").alias("source_size"), F.col("_mix_target").alias("target"), (F.col("_mix_size") * F.col("_mix_copies")).alias("taken"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("_sec_spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*[r.kind for r in BASE_RULES]))
    counts = [_count(spans, r.kind).cast("long").alias(f"n_{r.kind}") for r in BASE_RULES]
    return out.select("doc_id", *counts, F.sha2(span_list(base), 256).alias("base_sha256"), span_list(spans).alias("spans"))


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_language_id, op3_url_filter, op4_nearest_vectors, op5_decontaminate, op6_main_text, op7_line_dedup, op8_mix_sources, op9_toxicity, op10_secret_scan)}

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_RULE_CASES = {
    what: " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value(r)}'" for r in sorted(RULES, key=lambda r: (-len(r.text), r.text))
    )
    for what, value in (("rule", lambda r: r.text), ("verdict", lambda r: "allow" if r.allow else "block"))
}

ORACLES = {
    "op7_line_dedup": rf"""
        WITH base AS (
            SELECT doc_id, rn, string_split(coalesce(text, ''), chr(10)) AS lines
            FROM (SELECT *, row_number() OVER () AS rn FROM documents)),
        lines AS (
            SELECT doc_id, rn, i, lines[i] AS line, translate(trim(lines[i], chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '), {_UPPER}) AS k
            FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM base)),
        owner AS (SELECT k, min(doc_id) AS o, count(DISTINCT doc_id) AS n FROM lines WHERE length(k) >= 10 GROUP BY k)
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM (SELECT l.*, (o.n IS NOT NULL AND o.n >= 2 AND doc_id <> o.o) AS gone FROM lines l LEFT JOIN owner o ON l.k = o.k)
        GROUP BY rn, doc_id
    """,
    "op8_mix_sources": r"""
        WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
        named AS (
            SELECT source, sum(size)::BIGINT AS total, row_number() OVER (ORDER BY source IS NULL, source) AS nr FROM sized GROUP BY source),
        per AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][(nr - 1) % 3 + 1] AS w, total * 2.0::DOUBLE AS cap FROM named),
        walk AS (
            SELECT *, (sum(total) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS part
            FROM per),
        goal AS (SELECT source, total, least(cap, greatest(max(part) OVER (), 0) * w) AS target FROM walk),
        rated AS (
            SELECT s.doc_id, s.size, g.total, g.target, CASE WHEN g.total > 0 THEN g.target / g.total ELSE 0 END AS rate,
                   CAST('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, 'null') || ':mix'), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0::DOUBLE AS u
            FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source)
        SELECT doc_id, size, total AS source_size, target, (size * (floor(rate) + (u < rate - floor(rate))::INT))::BIGINT AS taken FROM rated
    """,
}
# Aliases by plain tags: one canonical link or refresh in double quotes with an absolute target or a path from the root.
ORACLES["op3_url_filter"] = rf"""
    WITH RECURSIVE parts AS (
        SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'), {_UPPER}) AS host,
               regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path,
               regexp_extract(coalesce(url, ''), '^.*?://', 0, 's') AS scheme, regexp_extract(coalesce(url, ''), '[?][^#]*', 0, 's') AS query FROM pages),
    ruled AS (SELECT *, CASE {_RULE_CASES['rule']} END AS rule, CASE {_RULE_CASES['verdict']} END AS own,
        CASE WHEN scheme <> '' THEN scheme || host || path || query END AS addr FROM parts),
    targets AS (
        SELECT scheme, host, addr, unnest(list_concat(regexp_extract_all(html, '<link rel="canonical" href="([^"]*)"', 1), regexp_extract_all(html, '<meta http-equiv="refresh" content="[0-9]+; url=([^"]*)"', 1))) AS t FROM ruled WHERE addr IS NOT NULL),
    absolute AS (SELECT addr, CASE WHEN starts_with(t, '/') THEN scheme || host || t ELSE t END AS t FROM targets),
    edges AS (SELECT addr AS a, split_part(t, '#', 1) AS b FROM absolute WHERE contains(t, '://')),
    sides AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
    ends AS (SELECT DISTINCT a, translate(regexp_extract(a, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), {_UPPER}) AS host, regexp_extract(a, '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM sides),
    judged AS (SELECT a, CASE {_RULE_CASES['verdict']} END AS v FROM ends),
    reach(x, y) AS (SELECT a, a FROM ends UNION SELECT r.x, e.b FROM reach r JOIN sides e ON r.y = e.a),
    alike AS (SELECT x, bool_or(coalesce(v = 'allow', false)) AS allowed, bool_or(coalesce(v = 'block', false)) AS blocked FROM reach JOIN judged ON y = a GROUP BY x)
    SELECT page_id, host, path, rule, coalesce(own, CASE WHEN blocked AND NOT allowed THEN 'block' ELSE 'allow' END) AS verdict FROM ruled LEFT JOIN alike ON addr = x
"""


def _sql_text(pattern: str) -> str:
    return pattern.replace("'", "''").replace(r"\x20", " ")


_SPANS = " UNION ALL ".join(
    f"SELECT doc_id, rn, {rank} AS rank, '{r.kind}' AS kind, {'true' if r in BASE_RULES else 'false'} AS base, {r.least} AS least, string_split_regex(text, '{_sql_text(r.pattern)}') AS gaps, "
    f"regexp_extract_all(text, '{_sql_text(r.pattern)}', 0) AS whole, regexp_extract_all(text, '{_sql_text(r.pattern)}', {r.group}) AS part FROM t"
    for rank, r in enumerate(RULES_OF_SECRETS)
)
_LIST = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank){where}, '')"
ORACLES["op10_secret_scan"] = rf"""
    WITH t AS (SELECT doc_id, row_number() OVER () AS rn, coalesce(text, '') AS text FROM documents),
    found AS ({_SPANS}),
    each AS (SELECT rn, rank, kind, base, least, unnest(range(1, len(whole) + 1)) AS i, gaps, whole, part FROM found),
    placed AS (
        SELECT rn, rank, kind, base, least, i, length(whole[i]) AS size, length(part[i]) AS own,
               sum(length(gaps[i]) + length(whole[i])) OVER (PARTITION BY rn, rank ORDER BY i)::BIGINT AS e FROM each),
    kept AS (SELECT rn, rank, kind, base, e - size AS s, e FROM placed WHERE own >= least),
    per AS (
        SELECT rn, {', '.join(f"count(*) FILTER (kind = '{r.kind}')::BIGINT AS n_{r.kind}" for r in BASE_RULES)},
               {_LIST.format(where=' FILTER (base)')} AS base, {_LIST.format(where='')} AS spans FROM kept GROUP BY rn)
    SELECT doc_id, {', '.join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in BASE_RULES)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM t LEFT JOIN per USING (rn)
"""

ORACLES["op1_ngram_join"] = rf"""
    WITH RECURSIVE worded AS (
        SELECT doc_id, row_number() OVER () AS rn, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), '[^\x20\x09-\x0D]+') AS w FROM documents),
    sets AS (
        SELECT doc_id, rn, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s FROM worded),
    sized AS (SELECT doc_id, rn, len(s) AS n, s FROM sets),
    grams AS (SELECT rn, n, unnest(s) AS g FROM sized),
    links AS (
        SELECT a.rn AS x, b.rn AS y FROM grams a JOIN grams b ON a.g = b.g AND a.rn <> b.rn
        GROUP BY a.rn, b.rn, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    reach(x, y) AS (SELECT rn, rn FROM sized UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
    SELECT s.doc_id, s.n::BIGINT AS n_shingles, min(t.doc_id) AS component_id
    FROM sized s JOIN reach r ON s.rn = r.x JOIN sized t ON t.rn = r.y GROUP BY s.rn, s.doc_id, s.n
"""
ORACLES["op4_nearest_vectors"] = """
    WITH v AS (
        SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS l, row_number() OVER () AS rn FROM v),
    p AS (
        SELECT q.vec_id AS query_id, c.vec_id, c.rn, max(list_dot_product(q.e, c.e) / (q.l * c.l)) AS score
        FROM n q JOIN n c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id GROUP BY ALL)
    SELECT query_id, rank::INT AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5
"""
