"""Joins, key sets, differences and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.catalog import roles as ro
from caselabel.catalog.registry import dated, query, rounded
from caselabel.functions import labels as lb
from caselabel.functions import text as tx
from caselabel.operators import aggregates as ag
from caselabel.operators import datasets as ds
from caselabel.operators import joins as jn
from caselabel.operators import keys as ky
from caselabel.operators import similar as sm

_LAST_LINE = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1"""


def lines(t):
    return t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_shipdate")


def line_order():
    return [F.col("l_shipdate"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]


@query(
    "join_left_enrich",
    f"""SELECT o_orderkey, o_orderstatus, l_suppkey AS l_suppkey_ult, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate_ult
    FROM orders LEFT JOIN ({_LAST_LINE}) ON l_orderkey = o_orderkey""",
)
def join_left_enrich(t):
    right = lines(t).withColumnRenamed("l_orderkey", "o_orderkey")
    out = jn.left_enrich(t.orders.select("o_orderkey", "o_orderstatus"), right, "o_orderkey", line_order(), "_ult")
    return dated(out.select("o_orderkey", "o_orderstatus", "l_suppkey_ult", "l_shipdate_ult"), "l_shipdate_ult")


@query("join_inner", "SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)")
def join_inner(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id")


@query(
    "join_left_override",
    f"""SELECT c.NDD, m.delitos_seguimiento AS delitos_seguimiento_predicted, c.ESTADO_ML
    FROM ({ro.CASES_SQL}) c LEFT JOIN ({ro.COMMISSION_RAW_SQL}) m ON m.NDD = c.NDD""",
)
def join_left_override(t):
    theirs = t.commission_raw().select("NDD", F.col("delitos_seguimiento").alias("delitos_seguimiento_predicted"))
    ours = t.cases().select("NDD", "delitos_seguimiento_predicted", "ESTADO_ML")
    return jn.left_override(
        ours, theirs, "NDD", ["delitos_seguimiento_predicted"], [F.col("delitos_seguimiento_predicted")]
    )


@query(
    "join_three_way",
    f"""SELECT o_orderkey AS clave, o_orderstatus AS estado, l_suppkey AS unidad_registry, l_linenumber AS linea_registry, c_name AS nombre_comision
    FROM orders LEFT JOIN ({_LAST_LINE}) ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_orderkey""",
)
def join_three_way(t):
    police = t.orders.select(F.col("o_orderkey").alias("clave"), F.col("o_orderstatus").alias("estado"))
    registry = t.lineitem.select(
        F.col("l_orderkey").alias("clave"), F.col("l_suppkey").alias("unidad"), F.col("l_linenumber").alias("linea"),
        F.col("l_shipdate").alias("fecha"), F.col("l_partkey").alias("orden"),
    )
    commission = t.customer.select(F.col("c_custkey").alias("clave"), F.col("c_name").alias("nombre"))
    order = [F.col("fecha"), F.col("linea"), F.col("orden"), F.col("unidad")]
    return jn.three_way(police, registry, commission, "clave", [order, [F.col("nombre")]]).select(
        "clave", "estado", "unidad_registry", "linea_registry", "nombre_comision"
    )


@query(
    "join_full_compare",
    """WITH a AS (SELECT strftime(o_orderdate, '%Y-%m') AS mes, COUNT(*) AS n_orders FROM orders GROUP BY 1),
    b AS (SELECT strftime(l_shipdate, '%Y-%m') AS mes, COUNT(*) AS n_lines FROM lineitem GROUP BY 1)
    SELECT mes, COALESCE(n_orders, 0) AS n_orders, COALESCE(n_lines, 0) AS n_lines FROM a FULL JOIN b USING (mes)""",
)
def join_full_compare(t):
    left = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("mes")).agg(F.count(F.lit(1)).alias("n_orders"))
    right = t.lineitem.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("mes")).agg(F.count(F.lit(1)).alias("n_lines"))
    return jn.full_compare(left, right, ["mes"], ["n_orders", "n_lines"])


@query("semi_known", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events)")
def semi_known(t):
    known = t.events.select(F.col("user_id").alias("c_custkey"))
    return ky.semi_known(t.customer.select("c_custkey", "c_name"), known, "c_custkey")


@query(
    "anti_new_keys",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
    AND c_custkey NOT IN (SELECT s_suppkey FROM supplier) AND c_custkey NOT IN (SELECT doc_id FROM labels)""",
)
def anti_new_keys(t):
    earlier = [
        t.events.select(F.col("user_id").alias("c_custkey")),
        t.supplier.select(F.col("s_suppkey").alias("c_custkey")),
        t.labels.select(F.col("doc_id").alias("c_custkey")),
    ]
    return ky.anti_new_keys(t.customer.select("c_custkey", "c_name"), *earlier, key="c_custkey")


_DIFF_SQL = """WITH l AS (SELECT c_nationkey AS nacion, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS segmento, COUNT(*) AS n FROM customer GROUP BY 1, 2),
  r AS (SELECT s_nationkey AS nacion, CASE WHEN s_acctbal > 5000 THEN 'BUILDING' WHEN s_acctbal < 0 THEN 'LOW' END AS segmento, COUNT(*) AS n FROM supplier GROUP BY 1, 2),
  j AS (SELECT COALESCE(l.nacion, r.nacion) AS nacion, COALESCE(l.segmento, r.segmento) AS segmento, COALESCE(l.n, 0) AS n_left, COALESCE(r.n, 0) AS n_right,
    CASE WHEN r.n IS NULL THEN 'left_only' WHEN l.n IS NULL THEN 'right_only' ELSE 'both' END AS "_merge"
    FROM l FULL JOIN r ON l.nacion IS NOT DISTINCT FROM r.nacion AND l.segmento IS NOT DISTINCT FROM r.segmento)"""


def _sides(t):
    left = t.customer.select(
        F.col("c_nationkey").alias("nacion"), F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("segmento")
    )
    balance = F.col("s_acctbal")
    right = t.supplier.select(
        F.col("s_nationkey").alias("nacion"), F.when(balance > 5000, "BUILDING").when(balance < 0, "LOW").alias("segmento")
    )
    return left, right


@query("dataframe_difference", f"""{_DIFF_SQL} SELECT * FROM j WHERE "_merge" <> 'both'""")
def dataframe_difference(t):
    return ky.row_difference(*_sides(t))


@query("dataframe_difference_both", f"""{_DIFF_SQL} SELECT * FROM j WHERE "_merge" = 'both'""")
def dataframe_difference_both(t):
    return ky.row_difference(*_sides(t), which="both")


@query("dataframe_difference_left", f"""{_DIFF_SQL} SELECT * FROM j WHERE "_merge" = 'left_only'""")
def dataframe_difference_left(t):
    return ky.row_difference(*_sides(t), which="left_only")


@query("dataframe_difference_right", f"""{_DIFF_SQL} SELECT * FROM j WHERE "_merge" = 'right_only'""")
def dataframe_difference_right(t):
    return ky.row_difference(*_sides(t), which="right_only")


@query(
    "left_join_where_right",
    "SELECT o_orderkey, l_linenumber, l_suppkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'",
)
def left_join_where_right(t):
    joined = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.where("l_returnflag = 'R'").select("o_orderkey", "l_linenumber", "l_suppkey")


@query(
    "train_test_leak",
    """SELECT DISTINCT sha256(text) AS digest FROM documents
    WHERE doc_id % 5 = 0 AND text IN (SELECT text FROM documents WHERE doc_id % 5 <> 0)""",
)
def train_test_leak(t):
    """A split by id alone: texts that have copies on both sides leak."""
    digested = t.documents.select(tx.text_digest(F.col("text")).alias("digest"), (F.col("doc_id") % 5 == 0).alias("test"))
    return ky.leaked_keys(digested.where("NOT test"), digested.where("test").select("digest"), "digest")


@query(
    "train_test_leak_split",
    f"""WITH s AS (SELECT {ro.NDD_SQL} AS NDD, CAST(('0x' || substring(md5('42#' || {ro.NDD_SQL}), 1, 8)) AS BIGINT) AS b FROM documents)
    SELECT COUNT(*) AS leaked FROM (SELECT NDD FROM s WHERE b >= 3865470566 INTERSECT SELECT NDD FROM s WHERE b < 3006477107)""",
)
def train_test_leak_split(t):
    split = ds.split_hash(t.cases().select("NDD"), "NDD")
    leaked = ky.leaked_keys(split.where("split = 'train'"), split.where("split = 'test'"), "NDD")
    return leaked.agg(F.count(F.lit(1)).alias("leaked"))


_TARGETS_SQL = ro.values_sql([(x,) for x in vocab.VALIDADOS], "target")


@query(
    "fuzzy_category_map",
    f"""WITH raw AS (SELECT DISTINCT {ro.norm_label_sql('DELITO_DESAGREGACION')} AS raw FROM ({ro.CASES_SQL}) WHERE DELITO_DESAGREGACION IS NOT NULL
      UNION SELECT DISTINCT {ro.norm_label_sql('delitos_seguimiento')} FROM ({ro.COMMISSION_RAW_SQL}) WHERE delitos_seguimiento IS NOT NULL),
    s AS (SELECT raw, target, CAST(round(100 * (1 - levenshtein(raw, target) / CAST(greatest(length(raw), length(target)) AS DOUBLE))) AS INTEGER) AS score
      FROM raw, (SELECT * FROM {_TARGETS_SQL}) g),
    b AS (SELECT raw, first(target ORDER BY score DESC, target) AS target, max(score) AS score FROM s GROUP BY raw)
    SELECT raw, CASE WHEN score > 85 THEN target ELSE 'No match found' END AS match, score FROM b""",
)
def fuzzy_category_map(t):
    raw = t.cases().select(lb.normalize_label(F.col("DELITO_DESAGREGACION")).alias("raw"))
    raw = raw.unionByName(t.commission_raw().select(lb.normalize_label(F.col("delitos_seguimiento")).alias("raw")))
    return jn.fuzzy_category_map(raw, "raw", vocab.VALIDADOS)


_WORDS_SQL = """w AS (SELECT DISTINCT unnest(regexp_split_to_array(text, '[ \\n]')) AS word FROM documents),
    g AS (SELECT DISTINCT unnest(regexp_split_to_array(text, '[ \\n]')) AS term FROM benchmark),
    p AS (SELECT word, term, CAST(round(100 * (1 - levenshtein(word, term) / CAST(greatest(length(word), length(term)) AS DOUBLE))) AS INTEGER) AS score
      FROM w, g WHERE regexp_full_match(word, '[!-~]{8,}') AND regexp_full_match(term, '[!-~]{8,}') AND abs(length(word) - length(term)) <= 0.2 * greatest(length(word), length(term)))"""


def long_words(df, name):
    """Words of eight characters or more; the twin's edit distance counts bytes, so only of ASCII."""
    return df.select(F.explode(F.split("text", "[ \\n]")).alias(name)).where(F.col(name).rlike("^[!-~]{8,}$"))


@query("similar_pairs", f"""WITH {_WORDS_SQL} SELECT word AS "left", term AS "right", score FROM p WHERE score > 80""")
def similar_pairs(t):
    return sm.similar_pairs(long_words(t.documents, "word"), "word", long_words(t.benchmark, "term"), "term", 80)


@query(
    "fuzzy_join",
    f"""WITH {_WORDS_SQL}, b AS (SELECT word, first(term ORDER BY score DESC, term) AS match, max(score) AS score FROM p WHERE score > 85 GROUP BY word)
    SELECT DISTINCT word, coalesce(match, 'No match found') AS match, score FROM w LEFT JOIN b USING (word) WHERE regexp_full_match(word, '[!-~]{{8,}}')""",
)
def fuzzy_join(t):
    """Each long word of the documents with the word of the benchmark that it may be a misspelling of."""
    return sm.best_matches(long_words(t.documents, "word"), "word", long_words(t.benchmark, "term"), "term")


@query("dedupe_last", f"SELECT l_orderkey, l_suppkey, l_partkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM ({_LAST_LINE})")
def dedupe_last(t):
    return dated(ky.dedupe_last(lines(t), ["l_orderkey"], line_order()), "l_shipdate")


@query(
    "duplicate_stats",
    """WITH c AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2)
    SELECT CAST(sum(n) AS BIGINT) AS n_rows, COUNT(*) AS n_keys, CAST(COALESCE(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicated_rows,
    CAST(sum(n - 1) AS BIGINT) AS extra_copies, round(100.0 * COALESCE(sum(n) FILTER (WHERE n > 1), 0) / CAST(sum(n) AS DOUBLE), 6) AS duplicated_pct FROM c""",
)
def duplicate_stats(t):
    return rounded(ky.duplicate_stats(t.lineitem, ["l_orderkey", "l_linenumber"]), "duplicated_pct")


@query(
    "duplicated_rows",
    """SELECT doc_id, n_chars, sha256(text) AS digest FROM documents WHERE text IN (SELECT text FROM documents GROUP BY text HAVING COUNT(*) > 1)""",
)
def duplicated_rows(t):
    return ky.duplicated_rows(t.documents.select("doc_id", "n_chars", tx.text_digest(F.col("text")).alias("digest")), ["digest"])


@query(
    "first_seen_and_cutoff",
    """SELECT c_custkey, strftime((SELECT min(ts) FROM events WHERE user_id = c_custkey), '%Y-%m-%d %H:%M:%S') AS first_seen,
    strftime((SELECT max(ts) FROM events), '%Y-%m-%d %H:%M:%S') AS cutoff FROM customer""",
)
def first_seen_and_cutoff(t):
    log = t.events.select(F.col("user_id").alias("c_custkey"), "ts")
    out = ag.first_seen_and_cutoff(t.customer.select("c_custkey"), log, "c_custkey", "ts")
    return dated(out, "first_seen", "cutoff", fmt="yyyy-MM-dd HH:mm:ss")
