"""Evaluation against the commission's labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.catalog import roles as ro
from caselabel.catalog.registry import query, rounded
from caselabel.operators import evaluation as ev
from caselabel.operators import labels as lo

_ORDER = ("delitos_seguimiento_comision", "delitos_validados_comision")
LABELS = vocab.SEGUIMIENTO

PAIRS_SQL = f"""WITH {ro.NORM_SQL}, {ro.score_sql('seguimiento', 'sg')}, commission AS ({ro.COMMISSION_SQL}),
pairs AS (SELECT NDD, {ro.norm_label_sql('delitos_seguimiento_comision')} AS y_true,
  CASE WHEN words >= 50 THEN sg.label ELSE 'N/A' END AS y_pred, FechaRegistroComision AS fecha
  FROM norm LEFT JOIN sg USING (NDD) JOIN commission USING (NDD)
  WHERE delitos_seguimiento_comision IS NOT NULL AND {ro.norm_label_sql('delitos_seguimiento_comision')} <> 'SIN INFORMACION')"""


def pairs(t, *also):
    scored = lo.gate_and_score(t.norm(), t.scorer("seguimiento"), "words", "delitos_seguimiento", "score")
    return ev.evaluation_pairs(
        scored.select("NDD", "delitos_seguimiento"),
        t.commission(),
        "NDD",
        "delitos_seguimiento_comision",
        "delitos_seguimiento",
        "Tipo_Delito_PJ_comision",
        "ROBO",
        vocab.NO_INFORMATION,
        [F.col(c) for c in _ORDER],
        also,
    )


def monthly(t):
    return pairs(t, "FechaRegistroComision").withColumn("mes", F.date_format("FechaRegistroComision", "yyyy-MM"))


@query("eval_prepare", f"{PAIRS_SQL} SELECT NDD, y_true, y_pred FROM pairs")
def eval_prepare(t):
    return pairs(t)


_GRID = ro.values_sql([(a, b) for a in LABELS for b in LABELS], "y_true, y_pred")
_MATRIX = f"""m AS (SELECT g.y_true, g.y_pred, COUNT(p.NDD) AS n FROM (SELECT * FROM {_GRID}) g LEFT JOIN pairs p ON p.y_true = g.y_true AND p.y_pred = g.y_pred GROUP BY 1, 2)"""


@query("confusion_matrix", f"{PAIRS_SQL}, {_MATRIX} SELECT * FROM m")
def confusion_matrix(t):
    return ev.confusion_matrix(pairs(t), "y_true", "y_pred", LABELS)


@query(
    "confusion_matrix_norm",
    f"""{PAIRS_SQL}, {_MATRIX} SELECT y_true, y_pred, round(CASE WHEN sum(n) OVER (PARTITION BY y_true) = 0 THEN 0.0
    ELSE n / CAST(sum(n) OVER (PARTITION BY y_true) AS DOUBLE) END, 6) AS share FROM m""",
)
def confusion_matrix_norm(t):
    return rounded(ev.confusion_matrix_norm(ev.confusion_matrix(pairs(t), "y_true", "y_pred", LABELS)), "share")


_CLASSES = """k AS (SELECT label, (SELECT COUNT(*) FROM pairs WHERE y_true = label AND y_pred = label) AS tp,
  (SELECT COUNT(*) FROM pairs WHERE y_true = label) AS support, (SELECT COUNT(*) FROM pairs WHERE y_pred = label) AS predicted
  FROM (SELECT y_true AS label FROM pairs UNION SELECT y_pred FROM pairs)),
c AS (SELECT label, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / CAST(predicted AS DOUBLE) END AS p, CASE WHEN support = 0 THEN 0.0 ELSE tp / CAST(support AS DOUBLE) END AS r, support, tp FROM k),
f AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1 FROM c)"""


@query(
    "classification_report",
    f"""{PAIRS_SQL}, {_CLASSES} SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support FROM f
    UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT round(sum(tp) / CAST(sum(support) AS DOUBLE), 6) AS a, CAST(sum(support) AS BIGINT) AS n FROM f)
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
    UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
      round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""",
)
def classification_report(t):
    return rounded(ev.classification_report(pairs(t), "y_true", "y_pred"), "precision", "recall", "f1")


@query(
    "accuracy",
    f"{PAIRS_SQL} SELECT COUNT(*) AS n, round(avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pairs",
)
def accuracy(t):
    return rounded(ev.accuracy(pairs(t), "y_true", "y_pred"), "accuracy")


@query(
    "multilabel_confusion",
    f"""{PAIRS_SQL}, {_CLASSES} SELECT label, (SELECT COUNT(*) FROM pairs WHERE y_true <> label AND y_pred <> label) AS tn,
    predicted - tp AS fp, support - tp AS fn, tp FROM k""",
)
def multilabel_confusion(t):
    return ev.multilabel_confusion(pairs(t), "y_true", "y_pred")


def _diff_sql(where: str) -> str:
    return f"""{PAIRS_SQL}, x AS (SELECT substring(fecha, 1, 7) AS month, y_true, y_pred FROM pairs {where}),
    a AS (SELECT month, y_true AS label, COUNT(*) AS n FROM x GROUP BY 1, 2), b AS (SELECT month, y_pred AS label, COUNT(*) AS n FROM x GROUP BY 1, 2)
    SELECT month, label, COALESCE(a.n, 0) AS n_true, COALESCE(b.n, 0) AS n_pred, COALESCE(a.n, 0) - COALESCE(b.n, 0) AS diff FROM a FULL JOIN b USING (month, label)"""


@query("count_diff_by_month", _diff_sql("WHERE y_true <> y_pred"))
def count_diff_by_month(t):
    return ev.count_difference(monthly(t), "mes", "y_true", "y_pred", mismatches_only=True)


@query("count_diff_total", _diff_sql(""))
def count_diff_total(t):
    return ev.count_difference(monthly(t), "mes", "y_true", "y_pred", mismatches_only=False)


@query(
    "abs_count_error",
    f"""{PAIRS_SQL}, a AS (SELECT y_true AS label, COUNT(*) AS n FROM pairs GROUP BY 1), b AS (SELECT y_pred AS label, COUNT(*) AS n FROM pairs GROUP BY 1),
    j AS (SELECT COALESCE(a.n, 0) AS t, COALESCE(b.n, 0) AS p FROM a FULL JOIN b USING (label))
    SELECT CAST(sum(abs(t - p)) AS BIGINT) AS abs_diff, CAST(sum(t) AS BIGINT) AS total, round(100.0 * sum(abs(t - p)) / CAST(sum(t) AS DOUBLE), 6) AS error_pct FROM j""",
)
def abs_count_error(t):
    return rounded(ev.abs_count_error(pairs(t), "y_true", "y_pred"), "error_pct")
