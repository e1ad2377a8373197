"""Gating, states, reconciliation and snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.catalog import roles as ro
from caselabel.catalog.q_sources import WEEKLY_SQL, weekly
from caselabel.catalog.registry import dated, query, rounded
from caselabel.functions import labels as lb
from caselabel.functions import text as tx
from caselabel.operators import keys as ky
from caselabel.operators import labels as lo
from caselabel.operators import snapshots as sn
from caselabel.operators.aggregates import category_counts
from caselabel.operators.scoring import score_with_lexicon_table
from caselabel.plans.refresh import prepare, refresh
from caselabel.plans.weekly import score_both
from caselabel.session import workspace
from caselabel.streaming.incremental import incremental_batch, run_available

WITH_NORM = f"WITH {ro.NORM_SQL}"
SEG = ro.score_sql("seguimiento", "sg")
VAL = ro.score_sql("validados", "va")
PREV = f"p AS ({ro.PREVIOUS_SQL})"


@query("lexicon_score", f"{WITH_NORM}, {SEG} SELECT n.NDD, sg.label, round(sg.score, 6) AS score FROM norm n LEFT JOIN sg USING (NDD)")
def lexicon_score(t):
    scored = t.scorer("seguimiento")(t.norm(), "label", "score", None)
    return rounded(scored.select("NDD", "label", "score"), "score")


@query("lexicon_score_table", f"{WITH_NORM}, {VAL} SELECT n.NDD, va.label, round(va.score, 6) AS score FROM norm n LEFT JOIN va USING (NDD)")
def lexicon_score_table(t):
    lexicon = t.spark.createDataFrame(list(ro.VALIDADOS_ENTRIES), "token string, label string, weight int")
    return rounded(score_with_lexicon_table(t.norm(), "NDD", "RELATO", lexicon, "label", "score"), "score")


@query(
    "gate_and_score",
    f"""{WITH_NORM}, {SEG} SELECT n.NDD, CASE WHEN words >= 50 THEN sg.label ELSE 'N/A' END AS delitos_seguimiento,
    round(CASE WHEN words >= 50 THEN sg.score ELSE 0.0 END, 6) AS score FROM norm n LEFT JOIN sg USING (NDD)""",
)
def gate_and_score(t):
    out = lo.gate_and_score(t.norm(), t.scorer("seguimiento"), "words", "delitos_seguimiento", "score")
    return rounded(out.select("NDD", "delitos_seguimiento", "score"), "score")


@query(
    "gate_new_only",
    f"""{WITH_NORM}, {SEG}, {PREV} SELECT n.NDD, CASE WHEN words >= 50 AND p.NDD IS NULL THEN sg.label ELSE 'N/A' END AS delitos_seguimiento,
    round(CASE WHEN words >= 50 AND p.NDD IS NULL THEN sg.score ELSE 0.0 END, 6) AS score FROM norm n LEFT JOIN sg USING (NDD) LEFT JOIN p ON p.NDD = n.NDD""",
)
def gate_new_only(t):
    cases = t.norm().select("NDD", "RELATO", "words")
    out = lo.gate_new_only(cases, t.previous(), t.scorer("seguimiento"), "NDD", "words", "delitos_seguimiento", "score")
    return rounded(out.select("NDD", "delitos_seguimiento", "score"), "score")


@query(
    "stateful_score",
    f"""{WITH_NORM}, {SEG} SELECT n.NDD, words >= 50 AS long_text,
    CASE WHEN ESTADO_ML = 0 AND words >= 50 THEN sg.label WHEN ESTADO_ML = 0 THEN 'OTROS ROBOS' ELSE delitos_seguimiento_predicted END AS label,
    round(CASE WHEN ESTADO_ML = 0 AND words >= 50 THEN sg.score WHEN ESTADO_ML = 0 THEN 0.0 ELSE delitos_seguimiento_predicted_score END, 6) AS score,
    CASE WHEN ESTADO_ML = 0 AND words >= 50 THEN 1 ELSE ESTADO_ML END AS estado FROM norm n LEFT JOIN sg USING (NDD)""",
)
def stateful_score(t):
    cases = t.norm().select(
        "NDD", "RELATO", "words", F.col("ESTADO_ML").alias("estado"),
        F.col("delitos_seguimiento_predicted").alias("label"), F.col("delitos_seguimiento_predicted_score").alias("score"),
    )
    out = lo.stateful_score(cases, t.scorer("seguimiento"), "words", "label", "score", "estado")
    return rounded(out.select("NDD", (F.col("words") >= 50).alias("long_text"), "label", "score", "estado"), "score")


@query(
    "init_states",
    f"SELECT NDD, ESTADO_ML, {', '.join(f'ESTADO_ML AS {s}' for s in lo.WORKING_STATES)} FROM ({ro.CASES_SQL})",
)
def init_states(t):
    return lo.init_states(t.cases().select("NDD", "ESTADO_ML"))


# the model that ran is read off the row: long texts by seguimiento, labelled languages by validados
_RAN_SQL = """SELECT NDD, ESTADO_ML, CASE WHEN words >= 50 AND ESTADO_ML = 0 THEN 1 ELSE ESTADO_ML END AS s,
  CASE WHEN lang = 'en' AND ESTADO_ML = 0 THEN 1 ELSE ESTADO_ML END AS v FROM norm"""


@query(
    "fold_state",
    f"""{WITH_NORM} SELECT NDD, s, v, CASE WHEN s = 1 AND v = 1 THEN 1 WHEN v = 1 THEN 2 WHEN s = 1 THEN 3 ELSE ESTADO_ML END AS estado FROM ({_RAN_SQL})""",
)
def fold_state(t):
    pending = F.col("ESTADO_ML") == 0
    ran = t.norm().select(
        "NDD",
        "ESTADO_ML",
        F.when((F.col("words") >= 50) & pending, 1).otherwise(F.col("ESTADO_ML")).alias("s"),
        F.when((F.col("lang") == "en") & pending, 1).otherwise(F.col("ESTADO_ML")).alias("v"),
    )
    return ran.select("NDD", "s", "v", lo.fold_state(F.col("ESTADO_ML"), F.col("s"), F.col("v")).alias("estado"))


@query(
    "unify_commission",
    f"{WEEKLY_SQL} SELECT NDD, delitos_seguimiento_unified_comision, delitos_seguimiento_unified_comision_origin FROM weekly",
)
def unify_commission(t):
    return weekly(t).select("NDD", "delitos_seguimiento_unified_comision", "delitos_seguimiento_unified_comision_origin")


@query(
    "unify_registry",
    f"""{WEEKLY_SQL} SELECT NDD, delitos_seguimiento_unified_siaf, delitos_seguimiento_unified_siaf_origin,
    delitos_validados_unified_siaf, delitos_validados_unified_siaf_origin FROM weekly""",
)
def unify_registry(t):
    return weekly(t).select(
        "NDD",
        *[c for s in vocab.SCHEMES for c in (f"delitos_{s}_unified_siaf", f"delitos_{s}_unified_siaf_origin")],
    )


@query(
    "origin_counts",
    f"""{WEEKLY_SQL} SELECT delitos_seguimiento_unified_comision_origin AS por_comision, delitos_seguimiento_unified_siaf_origin AS por_registro,
    COUNT(*) AS total FROM weekly GROUP BY 1, 2""",
)
def origin_counts(t):
    return (
        weekly(t)
        .groupBy(
            F.col("delitos_seguimiento_unified_comision_origin").alias("por_comision"),
            F.col("delitos_seguimiento_unified_siaf_origin").alias("por_registro"),
        )
        .agg(F.count(F.lit(1)).alias("total"))
    )


@query(
    "two_model_run",
    f"""{WEEKLY_SQL} SELECT delitos_seguimiento_predicted AS label, 'seguimiento' AS esquema, COUNT(*) AS total, '2024-02-01' AS corrida FROM weekly
    WHERE delitos_seguimiento_predicted IS NOT NULL GROUP BY 1
    UNION ALL SELECT delitos_validados_predicted, 'validados', COUNT(*), '2024-02-01' FROM weekly WHERE delitos_validados_predicted IS NOT NULL GROUP BY 1""",
)
def two_model_run(t):
    scored = score_both(t.cases().drop("lang", "source", "n_chars", "doc_id"), t.scorers(), ro.RUN_TIME)
    schemes = F.array(
        *[
            F.struct(
                F.col(f"delitos_{s}_predicted").alias("label"),
                F.lit(s).alias("esquema"),
                F.date_format(f"FechaActualizacionDelitos{s.capitalize()}", "yyyy-MM-dd").alias("corrida"),
            )
            for s in ("seguimiento", "validados")
        ]
    )
    long = scored.select(F.inline(schemes)).where("label IS NOT NULL")
    return long.groupBy("label", "esquema", "corrida").agg(F.count(F.lit(1)).alias("total"))


# --- refresh against the previous snapshot ------------------------------------
def _gated(prefix: str, alias: str) -> str:
    return f"CASE WHEN words >= 50 THEN {alias}.label ELSE 'N/A' END AS {prefix}, CASE WHEN words >= 50 THEN {alias}.score ELSE 0.0 END AS {prefix}_score"


_FILLED_SQL = f"""prior AS (SELECT NDD, relato AS RELATO, cantidad_palabras AS words, * EXCLUDE (NDD, relato, cantidad_palabras) FROM p),
{ro.score_sql('seguimiento', 'psg', 'prior')}, {ro.score_sql('validados', 'pva', 'prior')},
filled AS (SELECT p.* EXCLUDE (delitos_seguimiento, score_delitos_seguimiento, delitos_validados, score_delitos_validados),
  CASE WHEN p.delitos_seguimiento IS NOT NULL THEN p.delitos_seguimiento WHEN words >= 50 THEN psg.label ELSE 'N/A' END AS delitos_seguimiento,
  CASE WHEN p.delitos_seguimiento IS NOT NULL THEN p.score_delitos_seguimiento WHEN words >= 50 THEN psg.score ELSE 0.0 END AS score_delitos_seguimiento,
  CASE WHEN p.delitos_validados IS NOT NULL THEN p.delitos_validados WHEN words >= 50 THEN pva.label ELSE 'N/A' END AS delitos_validados,
  CASE WHEN p.delitos_validados IS NOT NULL THEN p.score_delitos_validados WHEN words >= 50 THEN pva.score ELSE 0.0 END AS score_delitos_validados
  FROM prior p LEFT JOIN psg USING (NDD) LEFT JOIN pva USING (NDD))"""
MERGED_SQL = f"""{WITH_NORM}, {SEG}, {VAL}, {PREV}, {_FILLED_SQL},
cur AS (SELECT n.NDD, RELATO AS relato, words, {_gated('s', 'sg')}, {_gated('v', 'va')} FROM norm n LEFT JOIN sg USING (NDD) LEFT JOIN va USING (NDD)),
merged AS (SELECT c.NDD, CAST(c.words AS INTEGER) AS cantidad_palabras, length(c.relato) AS n_text,
  CASE WHEN f.NDD IS NOT NULL THEN f.delitos_seguimiento ELSE c.s END AS delitos_seguimiento,
  round(CASE WHEN f.NDD IS NOT NULL THEN f.score_delitos_seguimiento ELSE c.s_score END, 6) AS score_delitos_seguimiento,
  CASE WHEN f.NDD IS NOT NULL THEN f.delitos_validados ELSE c.v END AS delitos_validados,
  round(CASE WHEN f.NDD IS NOT NULL THEN f.score_delitos_validados ELSE c.v_score END, 6) AS score_delitos_validados,
  CASE WHEN f.NDD IS NOT NULL THEN f.FechaActualizacion ELSE '2024-02-01 08:00:00' END AS FechaActualizacion
  FROM cur c LEFT JOIN filled f USING (NDD))"""


def refreshed(t, previous):
    cases = prepare(t.cases().select("NDD", "RELATO"), F.col("RELATO")).select("NDD", "relato", "cantidad_palabras")
    scorers = {f"delitos_{s}": t.scorer(s, "relato") for s in ("seguimiento", "validados")}
    return refresh(cases, previous, scorers, ro.RUN_TIME, [F.col("FechaActualizacion"), F.xxhash64("relato")])


@query(
    "merge_snapshots",
    f"{MERGED_SQL} SELECT *, CASE WHEN delitos_seguimiento = delitos_validados THEN 'OK' ELSE 'CHECK' END AS compare FROM merged",
)
def merge_snapshots(t):
    out = refreshed(t, t.previous())
    out = out.withColumn("n_text", F.length("relato").cast("bigint")).drop("relato")
    return rounded(dated(out, "FechaActualizacion", fmt="yyyy-MM-dd HH:mm:ss"), "score_delitos_seguimiento", "score_delitos_validados")


@query(
    "merge_snapshots_one_model",
    f"""{MERGED_SQL}, one AS (SELECT m.NDD, m.cantidad_palabras, m.n_text, m.delitos_seguimiento, m.score_delitos_seguimiento,
    p.delitos_validados, round(p.score_delitos_validados, 6) AS score_delitos_validados, m.FechaActualizacion, 'n-' || p.NDD AS nota
    FROM merged m LEFT JOIN p USING (NDD))
    SELECT *, CASE WHEN delitos_seguimiento = delitos_validados THEN 'OK' ELSE 'CHECK' END AS compare FROM one""",
)
def merge_snapshots_one_model(t):
    cases = prepare(t.cases().select("NDD", "RELATO"), F.col("RELATO")).select("NDD", "relato", "cantidad_palabras")
    previous = t.previous().withColumn("nota", F.concat(F.lit("n-"), "NDD"))
    scorers = {"delitos_seguimiento": t.scorer("seguimiento", "relato")}
    out = refresh(cases, previous, scorers, ro.RUN_TIME, [F.col("FechaActualizacion"), F.xxhash64("relato")])
    out = out.withColumn("n_text", F.length("relato").cast("bigint")).drop("relato")
    return rounded(dated(out, "FechaActualizacion", fmt="yyyy-MM-dd HH:mm:ss"), "score_delitos_seguimiento", "score_delitos_validados")


@query(
    "refresh_all",
    f"""{WITH_NORM}, {SEG}, {VAL} SELECT n.NDD, CAST(words AS INTEGER) AS cantidad_palabras, {_gated('delitos_seguimiento', 'sg')}, CASE WHEN words >= 50 THEN va.label ELSE 'N/A' END AS delitos_validados,
    CASE WHEN words < 50 OR sg.label = va.label THEN 'OK' ELSE 'CHECK' END AS compare FROM norm n LEFT JOIN sg USING (NDD) LEFT JOIN va USING (NDD)""".replace(
        "ELSE 0.0 END AS delitos_seguimiento_score", "ELSE 0.0 END AS delitos_seguimiento_raw"
    ).replace("SELECT n.NDD, CAST", "SELECT * EXCLUDE (delitos_seguimiento_raw) FROM (SELECT n.NDD, CAST") + ")",
)
def refresh_all(t):
    return refreshed(t, None).select("NDD", "cantidad_palabras", "delitos_seguimiento", "delitos_validados", "compare")


@query(
    "stamp_new",
    f"{WITH_NORM}, {PREV} SELECT NDD, CASE WHEN NDD NOT IN (SELECT NDD FROM p) THEN '2024-02-01 08:00:00' END AS FechaActualizacion FROM norm",
)
def stamp_new(t):
    flagged = ky.flag_new(t.cases().select("NDD"), t.previous(), "NDD")
    out = sn.stamp_new(flagged, "is_new", "FechaActualizacion", ro.RUN_TIME).drop("is_new")
    return dated(out, "FechaActualizacion", fmt="yyyy-MM-dd HH:mm:ss")


@query(
    "backfill_missing",
    f"""{WITH_NORM}, {PREV}, {_FILLED_SQL} SELECT NDD, delitos_seguimiento, round(score_delitos_seguimiento, 6) AS score_delitos_seguimiento FROM filled""",
)
def backfill_missing(t):
    out = sn.backfill_missing(
        t.previous(), t.scorer("seguimiento", "relato"), "cantidad_palabras", "delitos_seguimiento", "score_delitos_seguimiento"
    )
    return rounded(out.select("NDD", "delitos_seguimiento", "score_delitos_seguimiento"), "score_delitos_seguimiento")


_ALLOWED = {"seguimiento": vocab.SEGUIMIENTO, "validados": (*vocab.VALIDADOS, vocab.NOT_SCORED)}


def _allowed_sql(scheme: str) -> str:
    return ", ".join(f"'{x}'" for x in vocab.SCHEMES[scheme])


@query(
    "commission_override",
    f"""WITH c AS (SELECT NDD, {ro.norm_label_sql('delitos_seguimiento')} AS cs, delitos_validados AS cv FROM ({ro.COMMISSION_RAW_SQL}))
    SELECT k.NDD, CASE WHEN cs IN ({_allowed_sql('seguimiento')}) THEN cs ELSE delitos_seguimiento_predicted END AS delitos_seguimiento_predicted,
    CASE WHEN cv IN ({_allowed_sql('validados')}) THEN cv ELSE delitos_validados_predicted END AS delitos_validados_predicted
    FROM ({ro.CASES_SQL}) k LEFT JOIN c USING (NDD)""",
)
def commission_override(t):
    theirs = t.commission_raw().select(
        "NDD", lb.normalize_label(F.col("delitos_seguimiento")).alias("cs"), F.col("delitos_validados").alias("cv")
    )
    ours = t.cases().select("NDD", "delitos_seguimiento_predicted", "delitos_validados_predicted")
    columns = {"delitos_seguimiento_predicted": "cs", "delitos_validados_predicted": "cv"}
    allowed = {f"delitos_{s}_predicted": labels for s, labels in _ALLOWED.items()}
    return sn.commission_override(ours, theirs, "NDD", columns, allowed, [F.col("cs"), F.col("cv")])


@query(
    "full_or_new_mode",
    f"""{WITH_NORM}, {PREV} SELECT NDD, 'new' AS modo FROM norm WHERE NDD NOT IN (SELECT NDD FROM p)
    UNION ALL SELECT NDD, 'all' FROM norm UNION ALL SELECT NDD, 'unpredicted' FROM p WHERE delitos_seguimiento IS NULL""",
)
def full_or_new_mode(t):
    cases, previous = t.cases().select("NDD"), t.previous()
    new = sn.select_mode(cases, previous, "NDD", every=False).withColumn("modo", F.lit("new"))
    every = sn.select_mode(cases, previous, "NDD", every=True).withColumn("modo", F.lit("all"))
    missing = sn.unpredicted(previous, "delitos_seguimiento", "NDD").withColumn("modo", F.lit("unpredicted"))
    return new.unionByName(every).unionByName(missing)


# second narrative source: the pages with the same number
_TWO_SQL = f"""two AS (SELECT c.NDD, c.RELATO AS police, lower(regexp_replace(html, '<[^>]*>', '', 'g')) AS registry
  FROM cases c LEFT JOIN pages ON page_id = doc_id)"""


def two_sources(t):
    pages = t.pages.select(F.col("page_id").alias("doc_id"), F.lower(tx.strip_tags(F.col("html"))).alias("registry"))
    return t.cases().select("doc_id", "NDD", F.col("RELATO").alias("police")).join(pages, "doc_id", "left").drop("doc_id")


@query(
    "prefer_longer_source",
    f"""{WITH_NORM}, {_TWO_SQL} SELECT t.NDD, CASE WHEN n.words >= 50 THEN police ELSE COALESCE(registry, police) END AS relato
    FROM two t JOIN norm n USING (NDD)""",
)
def prefer_longer_source(t):
    return two_sources(t).select("NDD", sn.prefer_longer_source(F.col("police"), F.col("registry")).alias("relato"))


@query(
    "text_coverage",
    f"""{WITH_NORM}, {_TWO_SQL} SELECT COUNT(*) FILTER (WHERE police IS NULL) AS missing_first, COUNT(*) FILTER (WHERE registry IS NULL) AS missing_second,
    COUNT(*) FILTER (WHERE police IS NULL AND registry IS NULL) AS missing_both, COUNT(*) AS n_rows FROM two""",
)
def text_coverage(t):
    return sn.text_coverage(two_sources(t), "police", "registry")


@query(
    "incremental_run",
    f"""{WITH_NORM}, {SEG}, {PREV} SELECT n.NDD, CASE WHEN words >= 50 THEN sg.label ELSE 'N/A' END AS delitos_seguimiento,
    round(CASE WHEN words >= 50 THEN sg.score ELSE 0.0 END, 6) AS score FROM norm n LEFT JOIN sg USING (NDD) WHERE n.NDD NOT IN (SELECT NDD FROM p)""",
)
def incremental_run(t):
    scorer = t.scorer("seguimiento", "relato")

    def process(fresh):
        return lo.gate_and_score(fresh, scorer, "cantidad_palabras", "delitos_seguimiento", "score")

    arrived = prepare(t.cases().select("NDD", "RELATO"), F.col("RELATO")).select("NDD", "relato", "cantidad_palabras")
    out = incremental_batch(arrived, t.previous(), "NDD", [F.xxhash64("relato")], process)
    return rounded(out.select("NDD", "delitos_seguimiento", "score"), "score")


@query(
    "incremental_stream",
    f"""{WITH_NORM}, {SEG} SELECT n.NDD, CASE WHEN words >= 50 THEN sg.label ELSE 'N/A' END AS delitos_seguimiento,
    round(CASE WHEN words >= 50 THEN sg.score ELSE 0.0 END, 6) AS score FROM norm n LEFT JOIN sg USING (NDD)""",
)
def incremental_stream(t):
    """The document files as a stream: all that have arrived are scored and stored."""
    scorer, spark = t.scorer("seguimiento", "relato"), t.spark
    target, checkpoint = workspace(spark, "stream-out"), workspace(spark, "stream-checkpoint")

    def arrived(documents):
        return prepare(t.cases_from(documents).select("NDD", "RELATO"), F.col("RELATO"))

    def process(fresh):
        return lo.gate_and_score(fresh, scorer, "cantidad_palabras", "delitos_seguimiento", "score").select(
            "NDD", "delitos_seguimiento", "score"
        )

    run_available(
        spark, t.path("documents*"), t.documents.schema, target, checkpoint, "NDD", [F.xxhash64("relato")], process, arrived
    )
    return rounded(spark.read.parquet(target).drop("batch_id"), "score")


@query("label_distribution", f"""{WITH_NORM}, {SEG} SELECT CASE WHEN ESTADO_ML = 0 AND words >= 50 THEN sg.label WHEN ESTADO_ML = 0 THEN 'OTROS ROBOS' ELSE delitos_seguimiento_predicted END AS label,
    COUNT(*) AS total FROM norm n LEFT JOIN sg USING (NDD) GROUP BY 1 HAVING label IS NOT NULL""")
def label_distribution(t):
    scored = score_both(t.cases().drop("lang", "source", "n_chars", "doc_id"), {"seguimiento": t.scorer("seguimiento")}, ro.RUN_TIME)
    return category_counts(scored, "delitos_seguimiento_predicted")
