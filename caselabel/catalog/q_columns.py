"""Filters, renames, flags and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.catalog import roles as ro
from caselabel.catalog.registry import dated, query
from caselabel.functions import labels as lb
from caselabel.functions import text as tx
from caselabel.operators import aggregates as ag
from caselabel.operators import columns as cl
from caselabel.operators import filters as fl
from caselabel.operators import keys as ky
from caselabel.operators import snapshots as sn

WITH_NORM = f"WITH {ro.NORM_SQL}"


@query("filter_category", f"SELECT NDD, delitos_seguimiento FROM ({ro.COMMISSION_RAW_SQL}) WHERE Tipo_Delito_PJ = 'ROBO'")
def filter_category(t):
    return fl.filter_category(t.commission_raw(), "Tipo_Delito_PJ", "ROBO").select("NDD", "delitos_seguimiento")


@query("filter_word_range", f"{WITH_NORM} SELECT NDD, CAST(words AS INTEGER) AS words FROM norm WHERE words > 35 AND words <= 300")
def filter_word_range(t):
    return fl.filter_word_range(t.norm(), "words").select("NDD", "words")


@query("filter_max_words", f"{WITH_NORM} SELECT NDD, CAST(words AS INTEGER) AS words FROM norm WHERE words <= 300")
def filter_max_words(t):
    return fl.filter_max_words(t.norm(), "words").select("NDD", "words")


@query(
    "filter_known_labels",
    f"""WITH c AS (SELECT NDD, {ro.norm_label_sql('delitos_seguimiento')} AS seg, delitos_validados AS val FROM ({ro.COMMISSION_RAW_SQL}))
    SELECT seg, NDD, val FROM c WHERE seg <> 'SIN INFORMACION' AND seg IN (SELECT val FROM c WHERE val IS NOT NULL)""",
)
def filter_known_labels(t):
    pairs = t.commission_raw().select(
        lb.normalize_label(F.col("delitos_seguimiento")).alias("seg"), "NDD", F.col("delitos_validados").alias("val")
    )
    return fl.filter_known_labels(pairs, "seg", "val")


@query(
    "filter_predicted",
    f"""SELECT NDD, delitos_validados FROM ({ro.COMMISSION_RAW_SQL})
    WHERE delitos_validados IS DISTINCT FROM 'N/A' AND Tipo_Delito_PJ = 'ROBO'""",
)
def filter_predicted(t):
    return fl.filter_predicted(t.commission_raw(), "delitos_validados", "Tipo_Delito_PJ", "ROBO").select(
        "NDD", "delitos_validados"
    )


@query("drop_extra_columns", "SELECT c_custkey AS clave, c_name AS nombre FROM customer")
def drop_extra_columns(t):
    current = t.customer.withColumnsRenamed({"c_custkey": "clave", "c_name": "nombre"})
    earlier = t.supplier.withColumnsRenamed({"s_suppkey": "clave", "s_name": "nombre"})
    return cl.drop_extra_columns(current, earlier)


@query("strip_prefix_columns", 'SELECT s_suppkey AS "CLAVE", s_name AS "NOMBRE_UNIDAD", s_acctbal AS "X_SALDO" FROM supplier')
def strip_prefix_columns(t):
    raw = t.supplier.select(
        F.col("s_suppkey").alias("f_clave"), F.col("s_name").alias("d_nombre_unidad"), F.col("s_acctbal").alias("mes_d_x_saldo")
    )
    return cl.strip_prefix_columns(raw)


@query("camel_case_columns", 'SELECT p_partkey AS "pPartkey", p_name AS "pName", p_retailprice AS "pRetailprice" FROM part')
def camel_case_columns(t):
    return cl.camel_case_columns(t.part.select("p_partkey", "p_name", "p_retailprice"))


@query("suffix_columns", "SELECT s_suppkey, s_name AS s_name_comision, s_nationkey AS s_nationkey_comision FROM supplier")
def suffix_columns(t):
    return cl.suffix_columns(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), "_comision", ["s_suppkey"])


@query("strip_suffix_columns", "SELECT s_suppkey AS clave, s_name AS nombre, s_nationkey AS nacion FROM supplier")
def strip_suffix_columns(t):
    raw = t.supplier.select(
        F.col("s_suppkey").alias("clave"), F.col("s_name").alias("nombre_actual"), F.col("s_nationkey").alias("nacion_df1")
    )
    return cl.strip_suffix_columns(raw, "_actual", "_df1")


@query("label_project", f"{WITH_NORM} SELECT RELATO AS relato, delitos_validados_predicted AS labels FROM norm")
def label_project(t):
    return cl.label_project(t.norm(), "RELATO", "delitos_validados_predicted")


@query(
    "agreement_flag",
    f"""SELECT NDD, CASE WHEN {ro.norm_label_sql('delitos_seguimiento')} = delitos_validados THEN 'OK' ELSE 'CHECK' END AS compare
    FROM ({ro.COMMISSION_RAW_SQL})""",
)
def agreement_flag(t):
    left = lb.normalize_label(F.col("delitos_seguimiento"))
    return t.commission_raw().select("NDD", lb.agreement(left, F.col("delitos_validados")).alias("compare"))



def _words(column: str) -> str:
    return f"COALESCE(len(string_split({column}, ' ')), 0)"


@query(
    "text_equal_flag",
    f"""SELECT doc_id, CASE WHEN {_words('text')} = len(regexp_extract_all(text, '\\S+')) THEN 'IGUAL' ELSE 'DIFERENTE' END AS igual FROM documents""",
)
def text_equal_flag(t):
    text = F.col("text")
    return t.documents.select(
        "doc_id", lb.same_length_flag(tx.word_count_space(text), tx.word_count_ws(text)).alias("igual")
    )


@query("fill_empty_text", f"SELECT NDD, COALESCE(RELATO, '') AS RELATO FROM ({ro.CASES_SQL})")
def fill_empty_text(t):
    return fl.fill_empty_text(t.cases().select("NDD", "RELATO"), "RELATO")


@query(
    "contains_filter",
    f"SELECT NDD, DELITO_DESAGREGACION FROM ({ro.CASES_SQL}) WHERE contains(DELITO_DESAGREGACION, 'BIENES')",
)
def contains_filter(t):
    return fl.contains_filter(t.cases().select("NDD", "DELITO_DESAGREGACION"), "DELITO_DESAGREGACION", "BIENES")


@query(
    "one_hot",
    f"SELECT NDD, {', '.join(f'''CASE WHEN delitos_seguimiento_predicted = '{c}' THEN 1 ELSE 0 END AS is_{i}''' for i, c in enumerate(vocab.SEGUIMIENTO))} FROM ({ro.CASES_SQL})",
)
def one_hot(t):
    return t.cases().select("NDD", *lb.one_hot(F.col("delitos_seguimiento_predicted"), vocab.SEGUIMIENTO))


# --- set operations -----------------------------------------------------------
@query(
    "union_by_name",
    """SELECT c_custkey AS clave, c_name AS nombre, c_mktsegment AS segmento, CAST(NULL AS DOUBLE) AS saldo FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def union_by_name(t):
    first = t.customer.select(F.col("c_custkey").alias("clave"), F.col("c_name").alias("nombre"), F.col("c_mktsegment").alias("segmento"))
    second = t.supplier.select(F.col("s_acctbal").alias("saldo"), F.col("s_name").alias("nombre"), F.col("s_suppkey").alias("clave"))
    return first.unionByName(second, allowMissingColumns=True)


@query("key_intersection", "SELECT DISTINCT l_orderkey AS clave FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)")
def key_intersection(t):
    return ky.key_intersection(
        t.orders.select(F.col("o_orderkey").alias("clave")), t.lineitem.select(F.col("l_orderkey").alias("clave")), "clave"
    )


@query(
    "key_difference",
    """SELECT o_orderkey AS clave, 'orders' AS only_in FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT DISTINCT l_orderkey, 'lineitem' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
)
def key_difference(t):
    orders, lines = t.orders.select(F.col("o_orderkey").alias("clave")), t.lineitem.select(F.col("l_orderkey").alias("clave"))
    return ky.key_difference(orders, lines, "clave").withColumn("only_in", F.lit("orders")).unionByName(
        ky.key_difference(lines, orders, "clave").withColumn("only_in", F.lit("lineitem"))
    )


@query(
    "column_symdiff",
    f"""WITH {ro.NORM_SQL}, p AS ({ro.PREVIOUS_SQL})
    SELECT 'delitos_validados' AS column_name, CAST(COUNT(*) FILTER (WHERE delitos_validados IS NULL) AS BIGINT) AS nulls, COUNT(*) AS n_rows, 'left_only' AS side FROM p
    UNION ALL SELECT 'compare', COUNT(*) FILTER (WHERE compare IS NULL), COUNT(*), 'left_only' FROM p
    UNION ALL SELECT 'lang', COUNT(*) FILTER (WHERE lang IS NULL), COUNT(*), 'right_only' FROM norm""",
)
def column_symdiff(t):
    earlier = t.previous().select("NDD", "delitos_validados", "compare")
    return cl.column_symdiff(earlier, t.norm().select("NDD", "lang"))


@query(
    "label_set_diff",
    f"""SELECT DISTINCT {ro.norm_label_sql('delitos_seguimiento')} AS label FROM ({ro.COMMISSION_RAW_SQL}) c
    WHERE NOT EXISTS (SELECT 1 FROM ({ro.COMMISSION_RAW_SQL}) d WHERE d.delitos_validados IS NOT DISTINCT FROM {ro.norm_label_sql('c.delitos_seguimiento')})""",
)
def label_set_diff(t):
    commission = t.commission_raw()
    left = commission.select(lb.normalize_label(F.col("delitos_seguimiento")).alias("label"))
    return ag.label_set_diff(left, commission.select(F.col("delitos_validados").alias("label")), "label")


@query(
    "prior_snapshot_union",
    f"""WITH {ro.NORM_SQL}, p AS ({ro.PREVIOUS_SQL})
    SELECT NDD, delitos_seguimiento, 'previous' AS origen FROM p WHERE NDD NOT IN (SELECT NDD FROM norm)
    UNION ALL SELECT NDD, delitos_seguimiento_predicted, 'current' FROM norm""",
)
def prior_snapshot_union(t):
    older = t.previous().select("NDD", "delitos_seguimiento", F.lit("previous").alias("origen"))
    newer = t.cases().select("NDD", F.col("delitos_seguimiento_predicted").alias("delitos_seguimiento"), F.lit("current").alias("origen"))
    return sn.prior_snapshot_union(older, newer, "NDD")


@query(
    "overlap_matrix",
    """WITH s AS (SELECT 'orders' AS name, o_orderkey AS k FROM orders UNION SELECT 'lines', l_orderkey FROM lineitem UNION SELECT 'people', c_custkey FROM customer),
    n AS (SELECT DISTINCT name FROM s),
    b AS (SELECT x.name AS l, y.name AS r, COUNT(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.name <> y.name GROUP BY 1, 2),
    z AS (SELECT name, COUNT(*) AS c FROM s GROUP BY 1)
    SELECT a.name AS left_set, d.name AS right_set, COALESCE(b.c, 0) AS in_both, z.c - COALESCE(b.c, 0) AS left_only, z.c = COALESCE(b.c, 0) AS contained
    FROM n a JOIN n d ON a.name <> d.name JOIN z ON z.name = a.name LEFT JOIN b ON b.l = a.name AND b.r = d.name""",
)
def overlap_matrix(t):
    return ky.overlap_matrix(
        "k",
        orders=t.orders.select(F.col("o_orderkey").alias("k")),
        lines=t.lineitem.select(F.col("l_orderkey").alias("k")),
        people=t.customer.select(F.col("c_custkey").alias("k")),
    )


@query(
    "min_max_dates",
    "SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS first_date, strftime(max(o_orderdate), '%Y-%m-%d') AS last_date FROM orders",
)
def min_max_dates(t):
    return dated(ag.min_max_dates(t.orders, "o_orderdate"), "first_date", "last_date")
