"""Gating, the processing state and the reconciliation of label sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.functions import labels as lb
from caselabel.operators import keys as ky

# scorer(df, label_column, score_column, only) adds both columns where `only` holds
Scorer = Callable[[DataFrame, str, str, Column], DataFrame]

WORKING_STATES = (
    "ESTADO_ML_SEGUIMIENTO",
    "ESTADO_ML_VALIDADOS",
    "ESTADO_ML_SEGUIMIENTO_UNIFIED_COMISION",
    "ESTADO_ML_SEGUIMIENTO_UNIFIED_SIAF",
    "ESTADO_ML_VALIDADOS_UNIFIED_SIAF",
)


def long_enough(words: str, min_words: int = vocab.MIN_WORDS) -> Column:
    """The gate: enough words to be classified; missing text is not."""
    return F.coalesce(F.col(words) >= min_words, F.lit(False))


def gate_and_score(
    df: DataFrame, scorer: Scorer, words: str, label: str, score: str, min_words: int = vocab.MIN_WORDS, also: Column | None = None
) -> DataFrame:
    """Score long narratives; the others get ``N/A`` with score 0."""
    gate = long_enough(words, min_words) if also is None else long_enough(words, min_words) & also
    out = scorer(df.withColumn("_gate", gate), "_label", "_score", F.col("_gate"))
    return out.withColumns(
        {
            label: F.when(F.col("_gate"), F.col("_label")).otherwise(vocab.NOT_SCORED),
            score: F.when(F.col("_gate"), F.col("_score")).otherwise(F.lit(0.0)),
        }
    ).drop("_gate", "_label", "_score")


def gate_new_only(
    df: DataFrame, earlier: DataFrame, scorer: Scorer, key: str, words: str, label: str, score: str
) -> DataFrame:
    """As ``gate_and_score``, but only for keys absent from the earlier snapshot."""
    flagged = ky.flag_new(df, earlier, key, "_new")
    return gate_and_score(flagged, scorer, words, label, score, also=F.col("_new")).drop("_new")


def stateful_score(
    df: DataFrame, scorer: Scorer, words: str, label: str, score: str, state: str, min_words: int = vocab.MIN_WORDS
) -> DataFrame:
    """Advance the processing state of each case.

    State 0 and long: scored, state 1.  State 0 and short: ``OTROS ROBOS`` with
    score 0, still pending.  Any other state keeps label, score and state.
    """
    pending = F.col(state).eqNullSafe(0)
    gate = pending & long_enough(words, min_words)
    out = scorer(df.withColumns({"_pending": pending, "_gate": gate}), "_label", "_score", F.col("_gate"))
    return out.withColumns(
        {
            label: F.when(F.col("_gate"), F.col("_label")).when(F.col("_pending"), vocab.OTHER).otherwise(F.col(label)),
            score: F.when(F.col("_gate"), F.col("_score")).when(F.col("_pending"), F.lit(0.0)).otherwise(F.col(score)),
            state: F.when(F.col("_gate"), 1).otherwise(F.col(state)),
        }
    ).drop("_pending", "_gate", "_label", "_score")


def init_states(df: DataFrame, state: str = "ESTADO_ML") -> DataFrame:
    """Working copies of the state, one per processing step."""
    return df.withColumns({name: F.col(state) for name in WORKING_STATES})


def fold_state(state: Column, seguimiento: Column, validados: Column) -> Column:
    """Final state: 1 both models ran, 2 validados only, 3 seguimiento only, else unchanged.

    A case at 2 or 3 is not pending any more, so the other model never visits it.
    """
    return (
        F.when((seguimiento == 1) & (validados == 1), 1)
        .when(validados == 1, 2)
        .when(seguimiento == 1, 3)
        .otherwise(state)
    )


def _keep_or(unified: str, label: Column, origin: Column) -> dict[str, Column]:
    settled = F.col(unified).isNotNull()
    return {
        unified: F.when(settled, F.col(unified)).otherwise(label),
        f"{unified}_origin": F.when(settled, F.col(f"{unified}_origin")).otherwise(origin),
    }


def unify_commission(df: DataFrame, unified: str, predicted: str, commission: str, member: str, state: str) -> DataFrame:
    """Settle unsettled cases with the commission's label, else the model's.

    The commission decides for its own pending cases unless it says it has no
    information.  A missing commission label is a label that differs from that
    sentinel, hence it wins as NULL with origin ``COMISION``.
    """
    decides = F.col(member) & F.col(state).eqNullSafe(0) & ~F.col(commission).eqNullSafe(vocab.NO_INFORMATION)
    label = F.when(decides, F.col(commission)).otherwise(F.col(predicted))
    origin = F.when(decides, vocab.ORIGIN_COMMISSION).otherwise(vocab.ORIGIN_MODEL)
    return df.withColumns(_keep_or(unified, label, origin))


def unify_registry(
    df: DataFrame, unified: str, predicted: str, registry: str, words: str, state: str, min_words: int = vocab.MIN_WORDS
) -> DataFrame:
    """Settle unsettled cases too short for the model with the registry's label.

    A registry label to be reviewed does not decide; a missing one does, as
    NULL with origin ``SIAF``.
    """
    decides = (
        (F.coalesce(F.col(words), F.lit(0)) < min_words)
        & F.col(state).eqNullSafe(0)
        & ~F.col(registry).eqNullSafe(vocab.REVIEW_LABEL)
    )
    label = F.when(decides, F.col(registry)).otherwise(F.col(predicted))
    origin = F.when(decides, vocab.ORIGIN_REGISTRY).otherwise(vocab.ORIGIN_MODEL)
    return df.withColumns(_keep_or(unified, label, origin))


def recode(df: DataFrame, column: str, mapping: DataFrame, out: str | None = None) -> DataFrame:
    """Replace labels by a ``(raw_label, label)`` table; others pass through.

    Of repeated raw labels the least label counts, so rows never multiply.  The
    planner measures the table and broadcasts it if it is small.
    """
    table = mapping.groupBy(F.col("raw_label").alias("_raw")).agg(F.min("label").alias("_mapped"))
    joined = df.join(table, F.col(column) == F.col("_raw"), "left")
    return joined.withColumn(out or column, F.coalesce(F.col("_mapped"), F.col(column))).drop("_raw", "_mapped")


def map_category(df: DataFrame, raw: str, out: str, scheme: str) -> DataFrame:
    """Registry label normalised and recoded to a scheme."""
    mapping = vocab.registry_table(df.sparkSession, scheme)
    return recode(df.withColumn(out, lb.normalize_label(F.col(raw))), out, mapping)
