"""Agreement between true and predicted labels.

Everything derives from the counts per (true, predicted) pair, so the rows are
scanned once and all later work is on at most classes x classes rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caselabel.functions import labels as lb
from caselabel.operators import joins as jn


def pair_counts(df: DataFrame, true: str, predicted: str, labels: Iterable[str] | None = None) -> DataFrame:
    """Rows per known pair, within a label list if one is given: ``(y_true, y_pred, n)``.

    Unwanted pairs are dropped by their count: a filter on the labels would be
    pushed below the scorer's output and make it run a second time.
    """
    wanted = F.col(true).isNotNull() & F.col(predicted).isNotNull()
    if labels is not None:
        wanted = F.col(true).isin(*labels) & F.col(predicted).isin(*labels)
    counts = df.groupBy(F.col(true).alias("y_true"), F.col(predicted).alias("y_pred")).agg(F.count_if(wanted).alias("n"))
    return counts.where(F.col("n") > 0)


def confusion_matrix(df: DataFrame, true: str, predicted: str, labels: Iterable[str]) -> DataFrame:
    """Counts for every pair of a closed label list, zeros included."""
    labels = list(labels)
    grid = F.array(*[F.struct(F.lit(t).alias("y_true"), F.lit(p).alias("y_pred"), F.lit(0).cast("bigint").alias("n")) for t in labels for p in labels])
    zeros = df.sparkSession.range(1).select(F.inline(grid))
    return pair_counts(df, true, predicted, labels).unionByName(zeros).groupBy("y_true", "y_pred").agg(F.sum("n").alias("n"))


def confusion_matrix_norm(matrix: DataFrame) -> DataFrame:
    """Each count as share of its true label; a label never seen gives 0."""
    row = F.sum("n").over(W.partitionBy("y_true"))
    return matrix.select("y_true", "y_pred", F.coalesce(F.try_divide(F.col("n"), row), F.lit(0.0)).alias("share"))


def class_counts(pairs: DataFrame) -> DataFrame:
    """Per class from pair counts: ``(label, tp, support, predicted)``."""
    hit = F.col("y_true") == F.col("y_pred")
    zero = F.lit(0).cast("bigint")
    as_true = F.struct(
        F.col("y_true").alias("label"),
        F.when(hit, F.col("n")).otherwise(zero).alias("tp"),
        F.col("n").alias("support"),
        zero.alias("predicted"),
    )
    as_predicted = F.struct(
        F.col("y_pred").alias("label"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("predicted")
    )
    return (
        pairs.select(F.inline(F.array(as_true, as_predicted)))
        .groupBy("label")
        .agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted"))
    )


def classification_report(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and averages.

    A ratio whose denominator is zero is 0.  The ``accuracy`` row carries the
    accuracy in all three measures.
    """
    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    classes = class_counts(pair_counts(df, true, predicted))
    measured = classes.withColumn("precision", ratio(F.col("tp"), F.col("predicted"))).withColumn(
        "recall", ratio(F.col("tp"), F.col("support"))
    )
    p, r = F.col("precision"), F.col("recall")
    measured = measured.withColumn("f1", ratio(2 * p * r, p + r))
    measures = ("precision", "recall", "f1")
    total = F.sum("support")
    # a group of one label averages a single row; the grand total gives the averages
    rolled = measured.rollup("label").agg(
        F.grouping("label").alias("_total"),
        total.alias("support"),
        ratio(F.sum("tp"), total).alias("_accuracy"),
        *[F.avg(m).alias(m) for m in measures],
        *[ratio(F.sum(F.col(m) * F.col("support")), total).alias(f"_weighted_{m}") for m in measures],
    )

    def line(name: Column, *values: Column) -> Column:
        return F.struct(name.alias("label"), *[v.alias(m) for v, m in zip(values, measures)], F.col("support"))

    of_class = line(F.col("label"), *[F.col(m) for m in measures])
    of_all = F.array(
        line(F.lit("accuracy"), *[F.col("_accuracy")] * 3),
        line(F.lit("macro avg"), *[F.col(m) for m in measures]),
        line(F.lit("weighted avg"), *[F.col(f"_weighted_{m}") for m in measures]),
    )
    return rolled.select(F.inline(F.when(F.col("_total") == 0, F.array(of_class)).otherwise(of_all)))


def accuracy(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Share of rows with equal labels; a missing label never agrees."""
    hit = F.when(F.col(true) == F.col(predicted), 1.0).otherwise(0.0)
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def multilabel_confusion(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """One-against-rest counts per class: ``(label, tn, fp, fn, tp)``."""
    classes = class_counts(pair_counts(df, true, predicted))
    total = F.sum("support").over(W.partitionBy())
    fp, fn = F.col("predicted") - F.col("tp"), F.col("support") - F.col("tp")
    return classes.select(
        "label", (total - F.col("tp") - fp - fn).alias("tn"), fp.alias("fp"), fn.alias("fn"), "tp"
    )


def count_difference(df: DataFrame, month: str, true: str, predicted: str, mismatches_only: bool) -> DataFrame:
    """Counts per month and label by both label columns, and their difference."""
    differs = F.col("y_true").eqNullSafe(F.col("y_pred")) == F.lit(False)
    counts = df.groupBy(F.col(month).alias("month"), F.col(true).alias("y_true"), F.col(predicted).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n")
    )
    counted = F.when(differs, F.col("n")).otherwise(0) if mismatches_only else F.col("n")
    return _by_label(counts, counted, "month").withColumn("diff", F.col("n_true") - F.col("n_pred"))


def _by_label(counts: DataFrame, n: Column, *groups: str) -> DataFrame:
    """Counts per label as true and as predicted label, from counts per pair."""
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("y_true").alias("label"), n.cast("bigint").alias("n_true"), zero.alias("n_pred")),
        F.struct(F.col("y_pred").alias("label"), zero.alias("n_true"), n.cast("bigint").alias("n_pred")),
    )
    both = counts.select(*groups, F.inline(sides)).groupBy(*groups, "label").agg(
        F.sum("n_true").alias("n_true"), F.sum("n_pred").alias("n_pred")
    )
    return both.where(F.col("label").isNotNull() & (F.col("n_true") + F.col("n_pred") > 0))


def abs_count_error(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Sum of absolute count differences per label, in percent of all true labels."""
    counts = df.groupBy(F.col(true).alias("y_true"), F.col(predicted).alias("y_pred")).agg(F.count(F.lit(1)).alias("n"))
    both = _by_label(counts, F.col("n"))
    gap = F.sum(F.abs(F.col("n_true") - F.col("n_pred")))
    return both.agg(
        gap.alias("abs_diff"), F.sum("n_true").alias("total"), F.try_divide(100.0 * gap, F.sum("n_true")).alias("error_pct")
    )


def evaluation_pairs(
    predictions: DataFrame,
    commission: DataFrame,
    key: str,
    true: str,
    predicted: str,
    offence: str,
    offence_value: str,
    missing: str,
    order_by: list[Column],
    also: tuple[str, ...] = (),
) -> DataFrame:
    """Predictions beside the commission's label, both normalised: ``(key, y_true, y_pred)``.

    Only cases of the offence type with a real commission label are kept.  The
    commission's columns in ``also`` come along, from the row that counts.
    """
    theirs = commission.where(F.col(offence) == offence_value)
    paired = jn.left_enrich(predictions, theirs, key, order_by)
    out = paired.select(
        key, lb.normalize_label(F.col(true)).alias("y_true"), lb.normalize_label(F.col(predicted)).alias("y_pred"), *also
    )
    return out.where(F.col("y_true").isNotNull() & (F.col("y_true") != missing))
