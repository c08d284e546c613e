"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from likeness.llm.decontaminate import contaminated
from likeness.llm.exact_dedup import exact_dedup
from likeness.llm.lexical_search import rank_documents
from likeness.llm.licenses import scan_licenses
from likeness.llm.line_dedup import line_dedup
from likeness.llm.neighbours import nearest
from likeness.llm.ngram_join import ngram_join
from likeness.llm.pieces import encode
from likeness.llm.pii import find_pii
from likeness.llm.shared import documents
from likeness.llm.spelling import group_variants
from likeness.llm.substring_dedup import substring_dedup
from likeness.llm.toxicity import score_toxicity
from likeness.llm.url_filter import filter_urls

# text without A-Z capitals; words of the two kinds
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir)).drop("text_hash")


_SHINGLES = f"""
    d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, {_SPACED}) AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
              ELSE array_to_string(w[i:i + 4], ' ') END AS g
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)"""

OP1 = f"""
WITH RECURSIVE {_SHINGLES},
    c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b USING (g)
          WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
              WHERE 100 * shared >= 80 * (a.n + b.n - shared)),
    reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT r.x AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM reach r LEFT JOIN n ON n.doc_id = r.x GROUP BY r.x"""



def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir)).drop("all_spans")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir)).drop("kept_text")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir)).drop("blocks")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir), cache_edges=12_000_000, slice_bytes=1 << 20)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir), keep_text=False)


OP7 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w FROM documents),
    v AS (SELECT doc_id, i, hash(array_to_string(w[i:i + 12], ' ')) AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
    lost AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS least FROM v) WHERE doc_id > least),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM lost),
    kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n
             FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are all pages.  The tables have no dates and no lists, so both
    come from the pages: day and action by arithmetic on page_id, and every
    page's URL is also a list entry (domain, host or section, in turn)."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    captures = pages.withColumn("day", F.expr("(page_id * 37 + 11) % 365"))
    host = F.regexp_extract("url", r"://([^/?#:]+)", 1)
    section = F.regexp_extract("url", r"://([^/?#]+/[^/?#]*)", 1)
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    turn = F.expr("page_id % 3")
    entries = pages.select(
        F.when(turn == 0, domain).when(turn == 1, host).otherwise(section).alias("pattern"),
        F.expr("(page_id * 53 + 7) % 365").alias("day"), F.col("page_id").alias("seq"),
        F.when(F.expr("(page_id * 11) % 5 < 3"), "block").otherwise("allow").alias("action"))
    return filter_urls(captures, entries).fillna({"rule": "", "listed_on": -1})


OP8 = r"""
WITH p AS (SELECT page_id, (page_id * 37 + 11) % 365 AS day, regexp_extract(url, '://([^/?#:]+)', 1) AS host,
        regexp_extract(url, '://([^/?#]+/[^/?#]*)', 1) AS section, (page_id * 53 + 7) % 365 AS listed,
        CASE WHEN (page_id * 11) % 5 < 3 THEN 'block' ELSE 'allow' END AS action FROM pages),
    c AS (SELECT *, regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) AS domain FROM p),
    e AS (SELECT pattern, listed, arg_max(action, page_id) AS action
          FROM (SELECT *, CASE page_id % 3 WHEN 0 THEN domain WHEN 1 THEN host ELSE section END AS pattern FROM c) GROUP BY pattern, listed),
    m AS (SELECT c.page_id, c.day, k.pattern, k.level FROM c,
          LATERAL (SELECT * FROM (VALUES (c.domain, 1), (c.host, 2), (c.section, 3)) v(pattern, level)) k),
    f AS (SELECT m.page_id, m.day, m.pattern, m.level, e.action, e.listed FROM m ASOF JOIN e ON m.pattern = e.pattern AND m.day >= e.listed),
    b AS (SELECT page_id, arg_max(action, level) AS action, arg_max(pattern, level) AS rule, arg_max(listed, level) AS listed_on FROM f GROUP BY page_id)
SELECT c.page_id, c.day, coalesce(b.action = 'block', false) AS blocked, coalesce(b.rule, '') AS rule, coalesce(b.listed_on, -1) AS listed_on FROM c LEFT JOIN b USING (page_id)"""


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP9 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
    sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP10 = f"""
WITH {_SHINGLES},
    b AS (SELECT item_id, regexp_extract_all({_LOWERED}, {_SPACED}) AS w FROM benchmark),
    t AS (SELECT DISTINCT item_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
          FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
    m AS (SELECT item_id, count(*) AS n_item FROM t GROUP BY item_id)
SELECT doc_id, item_id, any_value(n_item) AS n_item, count(*) AS n_shared, count(*) / any_value(n_item) AS containment
FROM s JOIN t USING (g) JOIN m USING (item_id) GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n_item)"""


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
OP11 = f"""
WITH d AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, {_TERMS})) AS term FROM documents) GROUP BY ALL),
    q AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest(regexp_extract_all({_LOWERED}, {_TERMS})) AS term FROM benchmark) GROUP BY ALL),
    n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM d GROUP BY doc_id),
    a AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_all FROM n),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM d, a GROUP BY term, n_docs),
    m AS (SELECT doc_id, 100 - 25 + ((25 * n * n_docs) // n_all) AS m FROM n, a),
    s AS (SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
          FROM q JOIN d USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER k AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
WINDOW k AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER k <= 20"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(documents(spark, sf_dir))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_toxicity": op2_toxicity,
    "op3_pii": op3_pii,
    "op4_line_dedup": op4_line_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_lexical_search": op11_lexical_search,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

ORACLES = {
    "op1_ngram_join": OP1,
    "op7_substring_dedup": OP7,
    "op8_url_filter": OP8,
    "op9_exact_dedup": OP9,
    "op10_decontaminate": OP10,
    "op11_lexical_search": OP11,
}
