"""The weekly run over the case table, as one lazy plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselabel.functions import labels as lb
from caselabel.functions import text as tx
from caselabel.operators import joins as jn
from caselabel.operators import labels as lo
from caselabel.operators import snapshots as sn

# Columns the run writes back to the case table.
UPDATED = [
    "delitos_seguimiento_predicted",
    "delitos_seguimiento_predicted_score",
    "FechaActualizacionDelitosSeguimiento",
    "delitos_validados_predicted",
    "delitos_validados_predicted_score",
    "FechaActualizacionDelitosValidados",
    "delitos_seguimiento_comision",
    "delitos_validados_comision",
    "FechaCorteComision",
    "delitos_seguimiento_unified_comision",
    "delitos_seguimiento_unified_comision_origin",
    "delitos_seguimiento_unified_siaf",
    "delitos_seguimiento_unified_siaf_origin",
    "delitos_validados_unified_siaf",
    "delitos_validados_unified_siaf_origin",
    "ESTADO_ML",
]


def score_both(cases: DataFrame, scorers: dict[str, lo.Scorer], run_time: dt.datetime) -> DataFrame:
    """Normalise once, run both models on pending cases, fold the state.

    ``scorers`` may hold ``validados`` and ``seguimiento`` or only one of them.
    """
    words = tx.word_count_space(F.col("RELATO"))
    out = cases.withColumn("RELATO", tx.normalize_text(F.col("RELATO"))).withColumn("CANTIDAD_PALABRAS", words)
    out = lo.init_states(out)
    for scheme in ("validados", "seguimiento"):
        if scheme in scorers:
            label = f"delitos_{scheme}_predicted"
            out = lo.stateful_score(
                out, scorers[scheme], "CANTIDAD_PALABRAS", label, f"{label}_score", f"ESTADO_ML_{scheme.upper()}"
            ).withColumn(f"FechaActualizacionDelitos{scheme.capitalize()}", F.lit(run_time).cast("timestamp"))
    return out.withColumn(
        "ESTADO_ML", lo.fold_state(F.col("ESTADO_ML"), F.col("ESTADO_ML_SEGUIMIENTO"), F.col("ESTADO_ML_VALIDADOS"))
    )


def weekly_run(
    cases: DataFrame,
    commission: DataFrame | None,
    scorers: dict[str, lo.Scorer],
    run_time: dt.datetime,
    registry: bool = True,
) -> DataFrame:
    """Key and updated columns of every case, ready for ``update_from``.

    The narrative is dropped right after scoring, so the joins that follow
    shuffle labels and states but never the text.  The commission's latest
    registration date, a scalar subquery, is the cutoff date of every case.
    """
    out = score_both(cases, scorers, run_time)
    out = out.drop("RELATO")
    if commission is not None:
        theirs = commission.select(
            "NDD",
            lb.normalize_label(F.col("delitos_seguimiento_comision")).alias("delitos_seguimiento_comision"),
            "delitos_validados_comision",
            F.lit(True).alias("_member"),
        )
        order = [F.col("delitos_seguimiento_comision"), F.col("delitos_validados_comision")]
        ours = out.drop("delitos_seguimiento_comision", "delitos_validados_comision")
        out = jn.left_enrich(ours, theirs, "NDD", order).withColumn("_member", F.coalesce("_member", F.lit(False)))
        out = lo.unify_commission(
            out,
            "delitos_seguimiento_unified_comision",
            "delitos_seguimiento_predicted",
            "delitos_seguimiento_comision",
            "_member",
            "ESTADO_ML_SEGUIMIENTO_UNIFIED_COMISION",
        )
        if "FechaRegistroComision" in commission.columns:
            out = out.withColumn("FechaCorteComision", commission.select(F.max("FechaRegistroComision")).scalar())
    if registry:
        for scheme in ("seguimiento", "validados"):
            raw = f"DELITO_DESAGREGACION_{scheme.upper()}"
            out = lo.map_category(out, "DELITO_DESAGREGACION", raw, scheme)
            out = lo.unify_registry(
                out,
                f"delitos_{scheme}_unified_siaf",
                f"delitos_{scheme}_predicted",
                raw,
                "CANTIDAD_PALABRAS",
                f"ESTADO_ML_{scheme.upper()}_UNIFIED_SIAF",
            )
    return out.select("NDD", "CANTIDAD_PALABRAS", *[c for c in UPDATED if c in out.columns])


def apply_update(cases: DataFrame, result: DataFrame) -> DataFrame:
    """Case table with the run's columns written over the old ones; columns it lacks are added."""
    columns = [c for c in UPDATED if c in result.columns]
    lacking = {c: F.lit(None).cast(result.schema[c].dataType) for c in columns if c not in cases.columns}
    cases = cases.withColumns(lacking) if lacking else cases
    return sn.update_from(cases, result, "NDD", columns, [F.col("ESTADO_ML")])
