"""Readers and writers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from caselabel.catalog import roles as ro
from caselabel.catalog.registry import dated, query, rounded
from caselabel.functions import text as tx
from caselabel.operators import columns as cl
from caselabel.operators import labels as lo
from caselabel.operators import snapshots as sn
from caselabel.operators.datasets import class_ids
from caselabel.plans import resumable
from caselabel.plans.weekly import UPDATED, apply_update, weekly_run
from caselabel.session import workspace
from caselabel.sources import files, keyed, sinks, tables

WITH_NORM = f"WITH {ro.NORM_SQL}"


@query("scan_cases", f"{WITH_NORM} SELECT NDD, RELATO, CAST(words AS INTEGER) AS CANTIDAD_PALABRAS FROM norm")
def scan_cases(t):
    return tables.read_cases(t.cases().select("NDD", "RELATO"))


@query("scan_commission", ro.COMMISSION_SQL)
def scan_commission(t):
    return dated(t.commission(), "FechaIncidenteComision", "FechaRegistroComision")


_NARRATIVES_SQL = """SELECT lpad(CAST(page_id AS VARCHAR), 15, '0') AS codfisc, html AS obserinc,
  CASE WHEN url LIKE '%.net%' THEN 0 ELSE 1 END AS estado, CASE WHEN url LIKE 'https://m.%' THEN 'SI' ELSE 'NO' END AS anulada FROM pages"""


def narratives(t):
    return t.pages.select(
        tx.zero_pad_key(F.col("page_id").cast("string")).alias("codfisc"),
        F.col("html").alias("obserinc"),
        F.when(F.col("url").contains(".net"), 0).otherwise(1).alias("estado"),
        F.when(F.col("url").startswith("https://m."), "SI").otherwise("NO").alias("anulada"),
        F.col("url").alias("orden"),
    )


@query(
    "lookup_narratives",
    f"""SELECT codfisc AS NDD, lower(regexp_replace(obserinc, '<[^>]*>', '', 'g')) AS RELATO FROM ({_NARRATIVES_SQL})
    WHERE estado = 1 AND anulada = 'NO' AND codfisc IN (SELECT {ro.NDD_SQL} FROM documents)""",
)
def lookup_narratives(t):
    return tables.narratives_for(
        narratives(t), t.cases().select("NDD"), [F.col("orden")], clean=lambda c: F.lower(tx.strip_tags(c))
    )


@query("lookup_narratives_decoded")
def lookup_narratives_decoded(t):
    return tables.narratives_for(narratives(t), t.cases().select("NDD"), [F.col("orden")])


@query(
    "key_batch_lookup",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def key_batch_lookup(t):
    wanted = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    detail = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")
    return detail.join(wanted, "l_orderkey", "left_semi")


@query(
    "detail_by_key",
    """SELECT o_orderkey, c_name, n_name, o_orderstatus FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def detail_by_key(t):
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return t.orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "n_name", "o_orderstatus"
    )


@query(
    "scan_date_range",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS fecha FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1999-08-31'""",
)
def scan_date_range(t):
    found = tables.since(t.orders, "o_orderdate", dt.datetime(1996, 3, 1), dt.datetime(1999, 8, 31))
    return found.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha"))


@query(
    "scan_year",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS fecha FROM orders WHERE year(o_orderdate) = 1997",
)
def scan_year(t):
    return tables.in_year(t.orders, "o_orderdate", 1997).select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha")
    )


@query("scan_sample", f"SELECT NDD, RELATO FROM ({ro.CASES_SQL}) ORDER BY NDD LIMIT 1000")
def scan_sample(t):
    return tables.sample_first(t.cases().select("NDD", "RELATO"))


# Whole raw texts, line breaks, quotes and all, with NULL and empty ones among them.
_RAW_SQL = f"""SELECT {ro.NDD_SQL} AS NDD, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN '' ELSE text END AS RELATO,
  CAST(n_chars AS INTEGER) AS palabras FROM documents"""


def raw_texts(t):
    text = F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") % 7 == 1, "").otherwise(F.col("text"))
    key = tx.zero_pad_key(F.col("doc_id").cast("string"))
    return t.documents.select(key.alias("NDD"), text.alias("RELATO"), F.col("n_chars").cast("int").alias("palabras"))


@query("scan_csv_typed", _RAW_SQL)
def scan_csv_typed(t):
    path = sinks.save_csv(raw_texts(t), workspace(t.spark, "typed-csv"), "cases", ro.RUN_TIME.date())
    read = files.read_csv_typed(t.spark, path, "NDD string, RELATO string, palabras int", multiline=True)
    return read.drop("_corrupt_record")


@query(
    "multi_file_concat",
    """SELECT lpad(CAST(o_orderkey AS VARCHAR), 15, '0') AS NDD, o_orderpriority AS RELATO, 2019 AS anio FROM orders
    UNION ALL SELECT lpad(CAST(c_custkey AS VARCHAR), 15, '0'), c_mktsegment, 2020 FROM customer""",
)
def multi_file_concat(t):
    first, second = (f"{workspace(t.spark, 'yearly')}/{name}" for name in ("denuncias 2019", "denuncias 2020"))
    t.orders.select(F.col("o_orderkey").alias("NUMERO"), F.col("o_orderpriority").alias("TEXTO")).write.parquet(first)
    t.customer.select(F.col("c_custkey").alias("num_ndd"), F.col("c_mktsegment").alias("relato")).write.parquet(second)
    return files.read_yearly_files(t.spark, [first, second])


_PARTS_SQL = "lpad(CAST(l_orderkey AS VARCHAR), 15, '0') AS NDD, l_returnflag AS RELATO, CAST(substring(strftime(l_shipdate, '%Y'), 1, 4) AS INTEGER) AS anio"


@query("many_files_concat", f"SELECT {_PARTS_SQL} FROM lineitem")
def many_files_concat(t):
    """Folders of every year in three kinds, each kind with a header of its own."""
    root = workspace(t.spark, "many-files")
    lines = t.lineitem.select("l_orderkey", "l_returnflag", F.year("l_shipdate").alias("anio"), (F.col("l_linenumber") % 3).alias("kind"))
    paths = []
    for kind, header in enumerate((("NUMERO", "TEXTO"), ("num_ndd", "relato"), ("a b", "c.d"))):
        part = lines.where(F.col("kind") == kind).select(F.col("l_orderkey").alias(header[0]), F.col("l_returnflag").alias(header[1]), "anio")
        part.repartition("anio").write.partitionBy("anio").parquet(f"{root}/{kind}")
        years = t.spark.read.parquet(f"{root}/{kind}").select("anio").distinct().collect()  # a row per year
        paths += [f"{root}/{kind}/anio={r.anio}" for r in years]
    return files.read_yearly_files(t.spark, paths)


@query(
    "scan_typed_labelled",
    """WITH f AS (SELECT o_orderpriority AS relato, o_orderstatus AS labels, 'train' AS split FROM orders
    UNION ALL SELECT c_mktsegment, 'C', 'test' FROM customer)
    SELECT relato, labels, split, CAST(dense_rank() OVER (ORDER BY labels) - 1 AS INTEGER) AS id FROM f""",
)
def scan_typed_labelled(t):
    train, test = workspace(t.spark, "train-csv"), workspace(t.spark, "test-csv")
    t.orders.select(F.col("o_orderpriority").alias("relato"), F.col("o_orderstatus").alias("labels")).write.option(
        "header", True
    ).csv(train)
    t.customer.select(F.col("c_mktsegment").alias("relato"), F.lit("C").alias("labels")).write.option(
        "header", True
    ).csv(test)
    read = files.read_labelled_splits(t.spark, {"train": train, "test": test}).drop("_corrupt_record")
    ids = class_ids(read, "labels").withColumnRenamed("label", "labels")
    return read.join(ids, "labels").select("relato", "labels", "split", "id")


@query(
    "incremental_pull",
    f"""{WITH_NORM}, {ro.score_sql('seguimiento', 'sg')}
    SELECT n.NDD, CASE WHEN words >= 50 THEN label ELSE 'N/A' END AS label,
    round(CASE WHEN words >= 50 THEN score ELSE 0.0 END, 6) AS score FROM norm n LEFT JOIN sg USING (NDD)""",
)
def incremental_pull(t):
    """The cases, kept in buckets of their key, are scored step by step; a second call would find nothing left to do."""
    source, target = workspace(t.spark, "pull"), workspace(t.spark, "pulled")
    keyed.save_keyed(t.cases().select("NDD", "RELATO"), source, "NDD", 8)
    scorer = t.scorer("seguimiento")

    def score(cases):
        out = lo.gate_and_score(tables.read_cases(cases), scorer, "CANTIDAD_PALABRAS", "label", "score")
        return out.select("NDD", "label", "score")

    resumable.run_resumable(t.spark, source, target, score, buckets=8, per_step=4)
    return rounded(resumable.read_results(t.spark, target), "score")


# --- weekly result, shared by the sinks ---------------------------------------
WEEKLY_SQL = f"""{WITH_NORM}, {ro.score_sql('seguimiento', 'sg')}, {ro.score_sql('validados', 'va')},
commission AS ({ro.COMMISSION_SQL}),
scored AS (SELECT n.*,
  CASE WHEN ESTADO_ML = 0 AND words >= 50 THEN sg.label WHEN ESTADO_ML = 0 THEN 'OTROS ROBOS' ELSE delitos_seguimiento_predicted END AS seg,
  CASE WHEN ESTADO_ML = 0 AND words >= 50 THEN sg.score WHEN ESTADO_ML = 0 THEN 0.0 ELSE delitos_seguimiento_predicted_score END AS seg_score,
  CASE WHEN ESTADO_ML = 0 AND words >= 50 THEN va.label WHEN ESTADO_ML = 0 THEN 'OTROS ROBOS' ELSE delitos_validados_predicted END AS val,
  CASE WHEN ESTADO_ML = 0 AND words >= 50 THEN va.score WHEN ESTADO_ML = 0 THEN 0.0 ELSE delitos_validados_predicted_score END AS val_score,
  CASE WHEN ESTADO_ML = 0 AND words >= 50 THEN 1 ELSE ESTADO_ML END AS st
  FROM norm n LEFT JOIN sg USING (NDD) LEFT JOIN va USING (NDD)),
mapped AS (SELECT s.*, {ro.norm_label_sql('delitos_seguimiento_comision')} AS c_seg, c.delitos_validados_comision AS c_val,
  c.NDD IS NOT NULL AS member,
  COALESCE(ms.label, {ro.norm_label_sql('DELITO_DESAGREGACION')}) AS r_seg,
  COALESCE(mv.label, {ro.norm_label_sql('DELITO_DESAGREGACION')}) AS r_val
  FROM scored s LEFT JOIN commission c ON c.NDD = s.NDD
  LEFT JOIN (SELECT * FROM {ro.mapping_sql('seguimiento')}) ms ON ms.raw_label = {ro.norm_label_sql('DELITO_DESAGREGACION')}
  LEFT JOIN (SELECT * FROM {ro.mapping_sql('validados')}) mv ON mv.raw_label = {ro.norm_label_sql('DELITO_DESAGREGACION')}),
weekly AS (SELECT NDD, CAST(words AS INTEGER) AS CANTIDAD_PALABRAS, seg AS delitos_seguimiento_predicted,
  seg_score AS delitos_seguimiento_predicted_score, '2024-02-01 08:00:00' AS FechaActualizacionDelitosSeguimiento,
  val AS delitos_validados_predicted, val_score AS delitos_validados_predicted_score,
  '2024-02-01 08:00:00' AS FechaActualizacionDelitosValidados, c_seg AS delitos_seguimiento_comision, c_val AS delitos_validados_comision,
  CASE WHEN delitos_seguimiento_unified_comision IS NOT NULL THEN delitos_seguimiento_unified_comision
    WHEN member AND ESTADO_ML = 0 AND c_seg IS DISTINCT FROM 'SIN INFORMACION' THEN c_seg ELSE seg END AS delitos_seguimiento_unified_comision,
  CASE WHEN delitos_seguimiento_unified_comision IS NOT NULL THEN delitos_seguimiento_unified_comision_origin
    WHEN member AND ESTADO_ML = 0 AND c_seg IS DISTINCT FROM 'SIN INFORMACION' THEN 'COMISION' ELSE 'MODEL' END AS delitos_seguimiento_unified_comision_origin,
  CASE WHEN delitos_seguimiento_unified_siaf IS NOT NULL THEN delitos_seguimiento_unified_siaf
    WHEN words < 50 AND ESTADO_ML = 0 AND r_seg IS DISTINCT FROM 'REVIEW_LABEL' THEN r_seg ELSE seg END AS delitos_seguimiento_unified_siaf,
  CASE WHEN delitos_seguimiento_unified_siaf IS NOT NULL THEN delitos_seguimiento_unified_siaf_origin
    WHEN words < 50 AND ESTADO_ML = 0 AND r_seg IS DISTINCT FROM 'REVIEW_LABEL' THEN 'SIAF' ELSE 'MODEL' END AS delitos_seguimiento_unified_siaf_origin,
  CASE WHEN delitos_validados_unified_siaf IS NOT NULL THEN delitos_validados_unified_siaf
    WHEN words < 50 AND ESTADO_ML = 0 AND r_val IS DISTINCT FROM 'REVIEW_LABEL' THEN r_val ELSE val END AS delitos_validados_unified_siaf,
  CASE WHEN delitos_validados_unified_siaf IS NOT NULL THEN delitos_validados_unified_siaf_origin
    WHEN words < 50 AND ESTADO_ML = 0 AND r_val IS DISTINCT FROM 'REVIEW_LABEL' THEN 'SIAF' ELSE 'MODEL' END AS delitos_validados_unified_siaf_origin,
  st AS ESTADO_ML, (SELECT max(FechaRegistroComision) FROM commission) AS FechaCorteComision FROM mapped)"""
WEEKLY_ROUNDED = """SELECT * REPLACE (round(delitos_seguimiento_predicted_score, 6) AS delitos_seguimiento_predicted_score,
  round(delitos_validados_predicted_score, 6) AS delitos_validados_predicted_score) FROM weekly"""
_STAMPS = ("FechaActualizacionDelitosSeguimiento", "FechaActualizacionDelitosValidados")
_SCORES = ("delitos_seguimiento_predicted_score", "delitos_validados_predicted_score")


def weekly(t):
    return weekly_run(t.cases().drop("lang", "source", "n_chars", "doc_id"), t.commission(), t.scorers(), ro.RUN_TIME)


def weekly_text(df):
    return rounded(dated(dated(df, *_STAMPS, fmt="yyyy-MM-dd HH:mm:ss"), "FechaCorteComision"), *_SCORES)


@query("weekly_run", f"{WEEKLY_SQL} {WEEKLY_ROUNDED}")
def weekly_query(t):
    return weekly_text(weekly(t))


@query("save_table", f"{WEEKLY_SQL} {WEEKLY_ROUNDED}")
def save_table(t):
    path = sinks.save_table(weekly(t), workspace(t.spark, "weekly"))
    return weekly_text(t.spark.read.parquet(path))


@query("save_csv", _RAW_SQL)
def save_csv(t):
    path = sinks.save_csv(raw_texts(t), workspace(t.spark, "csv"), "cases", ro.RUN_TIME.date(), escape_lines=True)
    return files.read_csv_typed(t.spark, path, "NDD string, RELATO string, palabras int", escaped_lines=True).drop("_corrupt_record")


@query(
    "update_from",
    f"""{WEEKLY_SQL} SELECT c.NDD, w.ESTADO_ML, w.delitos_seguimiento_predicted, w.delitos_validados_predicted,
    w.delitos_seguimiento_unified_comision, w.delitos_seguimiento_unified_siaf, w.delitos_validados_unified_siaf_origin,
    c.DELITO_DESAGREGACION, length(c.RELATO) AS n_text FROM cases c JOIN weekly w USING (NDD)""",
)
def update_from(t):
    cases = t.cases().drop("lang", "source", "n_chars", "doc_id")
    updated = apply_update(cases, weekly(t))
    return updated.select(
        "NDD",
        "ESTADO_ML",
        "delitos_seguimiento_predicted",
        "delitos_validados_predicted",
        "delitos_seguimiento_unified_comision",
        "delitos_seguimiento_unified_siaf",
        "delitos_validados_unified_siaf_origin",
        "DELITO_DESAGREGACION",
        F.length("RELATO").cast("bigint").alias("n_text"),
    )


@query(
    "update_from_all_columns",
    f"""{WEEKLY_SQL}, r AS ({WEEKLY_ROUNDED}) SELECT c.NDD, {', '.join(f'r."{c}"' for c in UPDATED)}, c.DELITO_DESAGREGACION
    FROM cases c LEFT JOIN r USING (NDD)""",
)
def update_from_all_columns(t):
    cases = t.cases().drop("lang", "source", "n_chars", "doc_id", "RELATO")
    updated = apply_update(cases, weekly(t))
    return weekly_text(updated).select("NDD", *UPDATED, "DELITO_DESAGREGACION")


@query(
    "update_from_copies_nulls",
    f"""SELECT c.NDD, CASE WHEN m.NDD IS NOT NULL THEN m.delitos_seguimiento ELSE c.delitos_seguimiento_predicted END AS delitos_seguimiento_predicted
    FROM ({ro.CASES_SQL}) c LEFT JOIN ({ro.COMMISSION_RAW_SQL}) m ON c.NDD = m.NDD""",
)
def update_from_copies_nulls(t):
    source = t.commission_raw().select("NDD", F.col("delitos_seguimiento").alias("delitos_seguimiento_predicted"))
    target = t.cases().select("NDD", "delitos_seguimiento_predicted")
    return sn.update_from(
        target, source, "NDD", ["delitos_seguimiento_predicted"], [F.col("delitos_seguimiento_predicted")]
    )


_FEW_SQL = f"SELECT NDD, delitos_seguimiento FROM ({ro.COMMISSION_RAW_SQL}) WHERE NDD LIKE '%77'"


@query(
    "update_keyed",
    f"""SELECT c.NDD, c.DELITO_DESAGREGACION, length(c.RELATO) AS n_text, CASE WHEN m.NDD IS NOT NULL THEN m.delitos_seguimiento ELSE c.delitos_seguimiento_predicted END
    AS delitos_seguimiento_predicted FROM ({ro.CASES_SQL}) c LEFT JOIN ({_FEW_SQL}) m ON c.NDD = m.NDD""",
)
def update_keyed(t):
    """The cases kept in buckets of their key; the commission's labels of a few of them are set in place."""
    path, journal = workspace(t.spark, "keyed"), workspace(t.spark, "keyed-journal")
    keyed.save_keyed(t.cases().drop("lang", "source", "n_chars", "doc_id"), path, "NDD", 32)
    few = t.commission_raw().where(F.col("NDD").endswith("77"))
    few = few.select("NDD", F.col("delitos_seguimiento").alias("delitos_seguimiento_predicted"))
    columns = ["delitos_seguimiento_predicted"]
    keyed.update_keyed(t.spark, path, few, "NDD", columns, [F.col(c) for c in columns], 32, journal)
    out = keyed.read_keyed(t.spark, path)
    return out.select("NDD", "DELITO_DESAGREGACION", F.length("RELATO").cast("bigint").alias("n_text"), *columns)


def _repair_sql(column: str, index: int) -> str:
    from caselabel import vocab

    whens = " ".join(f"WHEN {column} = '{r[0]}' THEN '{r[index]}'" for r in vocab.UNIFIED_REPAIRS)
    return f"CASE {whens} ELSE {column} END AS {column}"


@query(
    "recode_update",
    f"""SELECT NDD, {_repair_sql('delitos_seguimiento_unified_siaf', 1)}, {_repair_sql('delitos_validados_unified_siaf', 2)}
    FROM ({ro.CASES_SQL})""",
)
def recode_update(t):
    cases = t.cases().select("NDD", "delitos_seguimiento_unified_siaf", "delitos_validados_unified_siaf")
    return sn.recode_update(
        cases, {"delitos_seguimiento_unified_siaf": "seguimiento", "delitos_validados_unified_siaf": "validados"}
    )


@query(
    "add_null_columns",
    """SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS unified_origin, CAST(NULL AS VARCHAR) AS unified_siaf_origin,
    CAST(NULL AS VARCHAR) AS validados_siaf_origin FROM customer""",
)
def add_null_columns(t):
    return cl.add_null_columns(
        t.customer.select("c_custkey", "c_name"), ["unified_origin", "unified_siaf_origin", "validados_siaf_origin"]
    )


_FILE_SQL = """SELECT DISTINCT CASE WHEN o_orderstatus = 'F' THEN 'matriz_' || strftime(o_orderdate, '%Y%m%d')
  ELSE 'INEC_' || strftime(o_orderdate, '%Y%m%d') || '_' || strftime(o_orderdate + INTERVAL 6 DAY, '%Y%m%d') || '_corte' END AS archivo FROM orders"""


@query(
    "period_from_name",
    f"""SELECT archivo, CASE WHEN archivo LIKE 'INEC%' THEN 'robosAI_' || substring(archivo, 12, 2) || substring(archivo, 10, 2) || substring(archivo, 8, 2)
    || '_' || substring(archivo, 21, 2) || substring(archivo, 19, 2) || substring(archivo, 17, 2) ELSE 'RobosAI' END AS tabla FROM ({_FILE_SQL})""",
)
def period_from_name(t):
    day = F.to_date("o_orderdate")
    dated_name = F.concat(
        F.lit("INEC_"), F.date_format(day, "yyyyMMdd"), F.lit("_"), F.date_format(F.date_add(day, 6), "yyyyMMdd"), F.lit("_corte")
    )
    other = F.concat(F.lit("matriz_"), F.date_format(day, "yyyyMMdd"))
    names = t.orders.select(F.when(F.col("o_orderstatus") == "F", other).otherwise(dated_name).alias("archivo")).distinct()
    return names.withColumn("tabla", sinks.period_name(F.col("archivo")))
