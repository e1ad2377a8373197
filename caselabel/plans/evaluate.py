"""Evaluation of predictions against the commission's labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from caselabel import vocab
from caselabel.operators import evaluation as ev


def evaluate(
    predictions: DataFrame, commission: DataFrame, predicted: str, order_by: list[Column], labels=vocab.SEGUIMIENTO
) -> dict[str, DataFrame]:
    """Lazy frames of one evaluation: pairs, matrix, shares, report and accuracy."""
    pairs = ev.evaluation_pairs(
        predictions,
        commission,
        "NDD",
        "delitos_seguimiento_comision",
        predicted,
        "Tipo_Delito_PJ_comision",
        "ROBO",
        vocab.NO_INFORMATION,
        order_by,
    )
    matrix = ev.confusion_matrix(pairs, "y_true", "y_pred", labels)
    return {
        "pairs": pairs,
        "matrix": matrix,
        "shares": ev.confusion_matrix_norm(matrix),
        "report": ev.classification_report(pairs, "y_true", "y_pred"),
        "accuracy": ev.accuracy(pairs, "y_true", "y_pred"),
        "count_error": ev.abs_count_error(pairs, "y_true", "y_pred"),
    }
