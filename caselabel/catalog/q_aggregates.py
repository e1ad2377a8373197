"""Counts, shares, pivots and distribution statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselabel.catalog import roles as ro
from caselabel.catalog.registry import query, rounded
from caselabel.functions import labels as lb
from caselabel.functions import text as tx
from caselabel.operators import aggregates as ag

WITH_NORM = f"WITH {ro.NORM_SQL}"
REGISTRY = ro.norm_label_sql("DELITO_DESAGREGACION")


def registry(t):
    return t.cases().select("NDD", "lang", "source", "n_chars", lb.normalize_label(F.col("DELITO_DESAGREGACION")).alias("etiqueta"))


_REG = f"(SELECT NDD, lang, source, n_chars, {REGISTRY} AS etiqueta FROM ({ro.CASES_SQL}))"
_SHARE = "CAST(CAST(round(100 * total / CAST(sum(total) OVER () AS DOUBLE), 2) AS DECIMAL(7, 2)) AS VARCHAR) || '%'"


@query(
    "category_share",
    f"SELECT label, total, {_SHARE} AS percentage FROM (SELECT etiqueta AS label, COUNT(NDD) AS total FROM {_REG} GROUP BY 1)",
)
def category_share(t):
    return ag.category_share(registry(t), "etiqueta", "NDD")


@query(
    "category_share_offence",
    f"""SELECT label, total, {_SHARE} AS percentage FROM (SELECT Tipo_Delito_PJ AS label, COUNT(NDD) AS total FROM ({ro.COMMISSION_RAW_SQL}) GROUP BY 1)""",
)
def category_share_offence(t):
    return ag.category_share(t.commission_raw(), "Tipo_Delito_PJ", "NDD")


@query("category_counts", f"SELECT etiqueta AS label, COUNT(*) AS total FROM {_REG} WHERE etiqueta IS NOT NULL GROUP BY 1")
def category_counts(t):
    return ag.category_counts(registry(t), "etiqueta")


@query(
    "category_summary",
    f"SELECT COUNT(etiqueta) AS labelled, COUNT(*) FILTER (WHERE etiqueta IS NULL) AS missing, COUNT(*) AS n_rows FROM {_REG}",
)
def category_summary(t):
    return ag.category_summary(registry(t), "etiqueta")


@query("group_count", f"SELECT etiqueta, lang, COUNT(NDD) AS total FROM {_REG} GROUP BY 1, 2")
def group_count(t):
    return ag.group_count(registry(t), ["etiqueta", "lang"], "NDD")


@query("group_sum_sorted", f"SELECT etiqueta, CAST(sum(n_chars) AS BIGINT) AS total FROM {_REG} GROUP BY 1")
def group_sum_sorted(t):
    return ag.group_sum_sorted(registry(t), "etiqueta", "n_chars")


@query("count_distinct_keys", "SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS n_keys FROM lineitem GROUP BY 1")
def count_distinct_keys(t):
    return ag.count_distinct_keys(t.lineitem, "l_returnflag", "l_orderkey")


@query("count_distinct_keys_approx")
def count_distinct_keys_approx(t):
    return ag.count_distinct_keys(t.lineitem, "l_returnflag", "l_orderkey", approximate=True)


@query(
    "filtered_counts",
    f"""{WITH_NORM} SELECT source, COUNT(*) FILTER (WHERE words > 50) AS above, COUNT(*) FILTER (WHERE words < 50) AS below,
    COUNT(*) FILTER (WHERE COALESCE(RELATO, '') = '') AS empty_text, COUNT(*) AS n_rows FROM norm GROUP BY 1""",
)
def filtered_counts(t):
    return ag.filtered_counts(t.norm(), "source", "RELATO", "words")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_LANGS = ["de", "en", "es", "fr"]


@query(
    "pivot_counts",
    f"SELECT c_nationkey, {', '.join(f'''COUNT(*) FILTER (WHERE c_mktsegment = '{s}') AS {s}''' for s in _SEGMENTS)} FROM customer GROUP BY 1",
)
def pivot_counts(t):
    return ag.pivot_counts(t.customer, "c_nationkey", "c_mktsegment", _SEGMENTS)


def _pivot_margin_sql() -> str:
    def columns():
        for name, value in (("casos", "1"), ("letras", "n_chars")):
            for lang in _LANGS:
                yield f"CAST(COALESCE(sum(CASE WHEN lang = '{lang}' THEN {value} END), 0) AS BIGINT) AS {name}_{lang}"
            yield f"CAST(COALESCE(sum({value}), 0) AS BIGINT) AS {name}_TOTAL"

    cols = ", ".join(columns())
    return f"SELECT etiqueta AS label, {cols} FROM {_REG} GROUP BY 1 UNION ALL SELECT 'TOTAL', {cols} FROM {_REG}"


def margins(t):
    measures = {"casos": F.count(F.lit(1)), "letras": F.sum("n_chars")}
    return ag.pivot_margins(registry(t), "etiqueta", "lang", _LANGS, measures)


@query("pivot_margins", _pivot_margin_sql())
def pivot_margins(t):
    return margins(t)


@query("crosstab_sorted", f"SELECT label, casos_TOTAL AS \"TOTAL\" FROM ({_pivot_margin_sql()})")
def crosstab_sorted(t):
    table = margins(t).select("label", F.col("casos_TOTAL").alias("TOTAL"))
    return ag.crosstab_sorted(table, "label")


@query("max_text_len", f"{WITH_NORM} SELECT lang, CAST(max(words) AS INTEGER) AS max_words FROM norm GROUP BY 1")
def max_text_len(t):
    return ag.max_text_len(t.norm(), "lang", F.col("words"))


_PROFILE = ["NDD", "RELATO", "DELITO_DESAGREGACION", "delitos_seguimiento_predicted", "delitos_validados_unified_siaf"]


@query(
    "null_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls, COUNT(*) AS n_rows FROM ({ro.CASES_SQL})" for c in _PROFILE
    ),
)
def null_profile(t):
    return ag.null_profile(t.cases().select(*_PROFILE))


_DESCRIBE = """SELECT COUNT(words) AS n, round(avg(words), 6) AS mean, round(stddev_samp(words), 6) AS std, CAST(min(words) AS INTEGER) AS min, CAST(max(words) AS INTEGER) AS max,
  CAST(quantile_cont(words, 0.25) AS DOUBLE) AS q1, CAST(quantile_cont(words, 0.5) AS DOUBLE) AS median, CAST(quantile_cont(words, 0.75) AS DOUBLE) AS q3 FROM norm"""


@query("word_count_describe", f"{WITH_NORM} {_DESCRIBE}")
def word_count_describe(t):
    return rounded(ag.describe(t.norm(), "words"), "mean", "std")


@query("word_count_describe_approx")
def word_count_describe_approx(t):
    return rounded(ag.describe(t.norm(), "words", approximate=True), "mean", "std")


@query(
    "boxplot_stats",
    f"""{WITH_NORM}, d AS ({_DESCRIBE}) SELECT q1, median, q3, q3 - q1 AS iqr, greatest(q1 - 1.5 * (q3 - q1), CAST(min AS DOUBLE)) AS lower_fence,
    q3 + 1.5 * (q3 - q1) AS upper_fence FROM d""",
)
def boxplot_stats(t):
    return ag.boxplot_stats(t.norm(), "words")


@query("boxplot_stats_approx")
def boxplot_stats_approx(t):
    return ag.boxplot_stats(t.norm(), "words", approximate=True)


#: A column with about as many values as rows.
_PRICES_SQL = "SELECT l_returnflag, CASE WHEN l_linenumber <> 7 THEN l_extendedprice * (1 - l_discount) * (1 + l_tax) - 40000 END AS words FROM lineitem"


def prices(t):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) - 40000
    return t.lineitem.select(F.when(F.col("l_linenumber") != 7, net).alias("words"))


_MANY = """SELECT COUNT(words) AS n, round(avg(words), 6) AS mean, round(stddev_samp(words), 6) AS std, min(words) AS min, max(words) AS max,
  quantile_cont(words, 0.25) AS q1, quantile_cont(words, 0.5) AS median, quantile_cont(words, 0.75) AS q3 FROM norm"""
_ROUNDED = "round({0}, 6) AS {0}"


@query(
    "describe_many_values",
    f"""WITH norm AS ({_PRICES_SQL}), d AS ({_MANY}) SELECT n, {', '.join(_ROUNDED.format(c) for c in ('mean', 'std', 'min', 'max', 'q1', 'median', 'q3'))} FROM d""",
)
def describe_many_values(t):
    return rounded(ag.describe(prices(t), "words", distinct="many"), "mean", "std", "min", "max", "q1", "median", "q3")


@query(
    "boxplot_many_values",
    f"""WITH norm AS ({_PRICES_SQL}), d AS ({_MANY}) SELECT round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
    round(greatest(q1 - 1.5 * (q3 - q1), min), 6) AS lower_fence, round(q3 + 1.5 * (q3 - q1), 6) AS upper_fence FROM d""",
)
def boxplot_many_values(t):
    return rounded(ag.boxplot_stats(prices(t), "words", distinct="many"), "q1", "median", "q3", "iqr", "lower_fence", "upper_fence")


@query(
    "exact_quantiles",
    f"""WITH norm AS ({_PRICES_SQL}) SELECT {', '.join(f'round(quantile_cont(words, {q}), 6) AS {n}' for n, q in (('p01', 0.01), ('p10', 0.1), ('p90', 0.9), ('p99', 0.99), ('p999', 0.999)))} FROM norm""",
)
def exact_quantiles(t):
    shares = {"p01": 0.01, "p10": 0.1, "p90": 0.9, "p99": 0.99, "p999": 0.999}
    return rounded(ag.exact_quantiles(prices(t), "words", shares), *shares)


@query(
    "histogram",
    f"""{WITH_NORM}, r AS (SELECT min(words) AS lo, (max(words) - min(words)) / 50.0 AS width FROM norm),
    b AS (SELECT CAST(least(floor((words - lo) / CAST(width AS DOUBLE)), 49) AS INTEGER) AS bin, CAST(lo AS DOUBLE) AS lo, CAST(width AS DOUBLE) AS width FROM norm, r)
    SELECT bin, round(lo + bin * width, 6) AS low, round(lo + (bin + 1) * width, 6) AS high, COUNT(*) AS n FROM b GROUP BY bin, lo, width""",
)
def histogram(t):
    return rounded(ag.histogram(t.norm(), "words", 50), "low", "high")


@query(
    "share_of_rows",
    f"SELECT COUNT(*) FILTER (WHERE Tipo_Delito_PJ = 'ROBO') AS matching, COUNT(*) AS n_rows, round(100.0 * avg(CASE WHEN Tipo_Delito_PJ = 'ROBO' THEN 1.0 ELSE 0.0 END), 6) AS share_pct FROM ({ro.COMMISSION_RAW_SQL})",
)
def share_of_rows(t):
    return rounded(ag.share_of_rows(t.commission_raw(), F.col("Tipo_Delito_PJ") == "ROBO"), "share_pct")


@query(
    "top_k_categories",
    "SELECT p_name AS label, COUNT(*) AS total FROM part GROUP BY 1 ORDER BY total DESC, label LIMIT 10",
)
def top_k_categories(t):
    return ag.top_k_categories(t.part, "p_name", 10)


@query(
    "lowest_confidence",
    f"""{WITH_NORM}, {ro.score_sql('seguimiento', 'sg')} SELECT NDD, label, round(score, 6) AS score FROM sg WHERE label = 'ROBO A DOMICILIO' ORDER BY sg.score, NDD LIMIT 5""",
)
def lowest_confidence(t):
    scored = t.scorer("seguimiento")(t.norm(), "label", "score", F.lit(True)).select("NDD", "label", "score")
    return rounded(ag.lowest_confidence(scored, "label", "ROBO A DOMICILIO", "score", "NDD"), "score")


@query(
    "word_counters",
    f"""SELECT lang, CAST(sum(len(string_split(text, ' '))) AS BIGINT) AS by_space,
    CAST(sum(len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'))) AS BIGINT) AS by_regex FROM documents GROUP BY 1""",
)
def word_counters(t):
    text = F.col("text")
    return t.documents.groupBy("lang").agg(
        F.sum(tx.word_count_space(text)).alias("by_space"), F.sum(tx.word_count_regex(text)).alias("by_regex")
    )
