"""Training, validation and test sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselabel.catalog import roles as ro
from caselabel.catalog.registry import query, rounded
from caselabel.functions import labels as lb
from caselabel.functions import text as tx
from caselabel.operators import datasets as ds

_HASH = "md5('42#' || NDD)"
_SPLIT_SQL = f"""SELECT NDD, lang, CASE WHEN b < 3006477107 THEN 'train' WHEN b < 3865470566 THEN 'valid' ELSE 'test' END AS split
  FROM (SELECT {ro.NDD_SQL} AS NDD, lang, CAST('0x' || substring(md5('42#' || {ro.NDD_SQL}), 1, 8) AS BIGINT) AS b FROM documents)"""


@query(
    "split_sizes",
    """SELECT COUNT(*) AS n_rows, CAST(COUNT(*) * CAST(0.7 AS DOUBLE) AS DOUBLE) AS train_size, CAST(COUNT(*) * CAST(0.2 AS DOUBLE) AS DOUBLE) AS valid_size,
    CAST(COUNT(*) * CAST(0.1 AS DOUBLE) AS DOUBLE) AS test_size FROM documents""",
)
def split_sizes(t):
    return ds.split_sizes(t.documents)


@query("split_hash", _SPLIT_SQL)
def split_hash(t):
    return ds.split_hash(t.cases().select("NDD", "lang"), "NDD")


@query(
    "split_exact",
    f"""WITH k AS (SELECT o_orderkey AS n, lpad(CAST(o_orderkey AS VARCHAR), 15, '0') AS NDD FROM orders),
    r AS (SELECT NDD, row_number() OVER (ORDER BY {_HASH}, NDD) AS rk, COUNT(*) OVER () AS n FROM k),
    z AS (SELECT *, CAST(ceil(n * 0.1) AS BIGINT) AS nt FROM r)
    SELECT NDD, CASE WHEN rk <= nt THEN 'test' WHEN rk <= nt + CAST(ceil((n - nt) * 0.2) AS BIGINT) THEN 'valid' ELSE 'train' END AS split FROM z""",
)
def split_exact(t):
    keys = t.orders.select(tx.zero_pad_key(F.col("o_orderkey").cast("string")).alias("NDD"))
    return ds.split_exact(keys, "NDD", test_size=0.1)


@query(
    "split_exact_count",
    f"""WITH k AS (SELECT DISTINCT lpad(CAST(l_orderkey AS VARCHAR), 15, '0') AS NDD FROM lineitem),
    r AS (SELECT NDD, row_number() OVER (ORDER BY {_HASH}, NDD) AS rk, COUNT(*) OVER () AS n FROM k),
    s AS (SELECT CASE WHEN rk <= 500 THEN 'test' WHEN rk <= 500 + CAST(ceil((n - 500) * 0.2) AS BIGINT) THEN 'valid' ELSE 'train' END AS split FROM r)
    SELECT split, COUNT(*) AS n FROM s GROUP BY 1""",
)
def split_exact_count(t):
    lines = t.lineitem.select(tx.zero_pad_key(F.col("l_orderkey").cast("string")).alias("NDD"))
    return ds.split_exact(lines, "NDD", test_size=500).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("seeded_sample", f"SELECT NDD, lang FROM (SELECT {ro.NDD_SQL} AS NDD, lang FROM documents) ORDER BY md5('7#' || NDD), NDD LIMIT 50")
def seeded_sample(t):
    return ds.seeded_sample(t.cases().select("NDD", "lang"), "NDD", 50, seed=7)


@query(
    "split_balance",
    f"""WITH c AS (SELECT split, lang, COUNT(*) AS n FROM ({_SPLIT_SQL}) GROUP BY 1, 2)
    SELECT split, lang, n, round(100.0 * n / CAST(sum(n) OVER (PARTITION BY split) AS DOUBLE), 6) AS label_pct,
    round(100.0 * sum(n) OVER (PARTITION BY split) / CAST(sum(n) OVER () AS DOUBLE), 6) AS split_pct FROM c""",
)
def split_balance(t):
    split = ds.split_hash(t.cases().select("NDD", "lang"), "NDD")
    return rounded(ds.split_balance(split, "split", "lang"), "label_pct", "split_pct")


@query(
    "pair_sources",
    f"""WITH {ro.NORM_SQL}, two AS (SELECT c.NDD, c.lang, c.RELATO AS police, lower(regexp_replace(html, '<[^>]*>', '', 'g')) AS registry
      FROM cases c LEFT JOIN pages ON page_id = doc_id)
    SELECT NDD, lang, 'police' AS source, police AS relato FROM two WHERE police IS NOT NULL
    UNION ALL SELECT NDD, lang, 'registry', registry FROM two WHERE registry IS NOT NULL""",
)
def pair_sources(t):
    pages = t.pages.select(F.col("page_id").alias("doc_id"), F.lower(tx.strip_tags(F.col("html"))).alias("registry"))
    both = t.cases().select("doc_id", "NDD", "lang", F.col("RELATO").alias("police")).join(pages, "doc_id", "left")
    return ds.pair_sources(both, "NDD", {"police": "police", "registry": "registry"}, ["lang"])


@query(
    "class_ids",
    f"""SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS id
    FROM (SELECT DISTINCT {ro.norm_label_sql('delitos_seguimiento')} AS label FROM ({ro.COMMISSION_RAW_SQL})) WHERE label IS NOT NULL""",
)
def class_ids(t):
    named = t.commission_raw().select(lb.normalize_label(F.col("delitos_seguimiento")).alias("label"))
    return ds.class_ids(named, "label")
