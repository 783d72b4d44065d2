"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    divergence,
    exact_dedup,
    html_extract,
    license_scan,
    lm_scoring,
    mixing,
    packing,
    quality_rules,
    simhash,
    spelling,
    suffix_dedup,
    topk_search,
    url_filters,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filters.judge(_table(spark, sf_dir, "pages"))
    return judged.select("page.page_id", "host", "path", "rule", "verdict")


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select(
        "page.page_id", "page.url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, ["doc_id"])
    return mixed.select("doc.doc_id", "size", "source_size", "target", "taken", "position")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = suffix_dedup.removed(docs, ["doc_id"])
    return cut.select("doc.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality_rules.measure(_table(spark, sf_dir, "documents"))
    return measured.select("doc.doc_id", *measured.columns[1:])


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return grouped.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup.mark(_table(spark, sf_dir, "documents"), ["doc_id"])
    return marked.select("doc.doc_id", *marked.columns[1:])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_topk_search,
        op2_packing,
        op3_url_filters,
        op4_html_extract,
        op5_mixing,
        op6_suffix_dedup,
        op7_lm_scoring,
        op8_quality_rules,
        op9_simhash,
        op10_license_scan,
        op11_spelling_variants,
        op12_source_divergence,
        op13_exact_dedup,
    )
    return {f.__name__: f for f in registered}


QUALITY_SQL = r"""
WITH d AS (SELECT row_number() OVER () rid, doc_id, coalesce(text, '') t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) lines FROM d),
g AS (SELECT rid, i, w[i:i+7] g FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) i FROM w)),
a AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) n FROM g) WHERE n > 1),
r AS (SELECT rid, count(*) n FROM (SELECT DISTINCT rid, unnest(range(i, i + 8)) p FROM a) GROUP BY rid),
c AS (SELECT doc_id, t, w, lines, len(w)::BIGINT n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT n_dup_lines, coalesce(r.n, 0)::BIGINT n_repeat_words
  FROM w LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT 10 * n_symbols > 3 * n_words
  AND NOT 2 * length(regexp_replace(t, '[^!]', '', 'g')) > n_words
  AND NOT word_chars > 25 * n_words AND NOT 2 * word_chars < 3 * n_words
  AND NOT 10 * len(list_distinct(lines)) < 3 * len(lines) kept FROM b
"""


SEARCH_SQL = """
WITH v AS (SELECT row_number() OVER () rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) v
  FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rid, a.vec_id query_id, b.vec_id, list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.rid <> b.rid),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () rid, coalesce(lang, '') lang, coalesce(source, '') source, coalesce(text, '') t FROM documents),
w AS (SELECT rid, lang, source, translate(unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') term FROM d),
k AS (SELECT rid, lang, source, term, count(*) n FROM w GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::BIGINT n FROM k GROUP BY lang, term HAVING count(*) >= 3),
v AS (SELECT lang, count(*) v, sum(n)::HUGEINT total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, sum(k.n)::BIGINT n FROM k SEMI JOIN kept USING (lang, term) GROUP BY ALL),
t AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
f AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (t.total + v.v) p,
  1 + (1000000000::HUGEINT * (kept.n + 1)) // (v.total + v.v) q
  FROM g JOIN kept USING (lang) JOIN v USING (lang) JOIN t USING (lang, source) LEFT JOIN c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
sums AS (SELECT a.lang, a.source, b.source item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) value
  FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT lang, source, 'pair' part, item, coalesce(value, 0) value FROM pairs LEFT JOIN sums USING (lang, source, item)
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM f WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, value::BIGINT value, rank::INT AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""


EXACT_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) keep_id, count(*) OVER (PARTITION BY t) group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 kept, sha256(t) text_sha256 FROM n
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_topk_search": SEARCH_SQL,
        "op8_quality_rules": QUALITY_SQL,
        "op12_source_divergence": DIVERGENCE_SQL,
        "op13_exact_dedup": EXACT_SQL,
    }
