"""Identities of the evaluation tables, and the data-set splits."""

import math

import pytest
from pyspark.sql import functions as F

from caselabel.operators import datasets as ds
from caselabel.operators import evaluation as ev
from caselabel.operators import privacy as pv

# never predicted: D; never true: E; perfect: C
PAIRS = [("A", "A")] * 5 + [("A", "B")] * 2 + [("B", "A")] + [("B", "B")] * 3 + [("C", "C")] * 4 + [("D", "A")] * 2 + [("A", "E")]
LABELS = ["A", "B", "C", "D", "E", "F"]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([*PAIRS, (None, "A"), ("A", None)], "t string, p string")


def test_matrix(pairs):
    got = {(r.y_true, r.y_pred): r.n for r in ev.confusion_matrix(pairs, "t", "p", LABELS).collect()}
    assert got == {(t, p): PAIRS.count((t, p)) for t in LABELS for p in LABELS}
    part = {(r.y_true, r.y_pred): r.n for r in ev.confusion_matrix(pairs, "t", "p", ["A", "B"]).collect()}
    assert part == {(t, p): PAIRS.count((t, p)) for t in "AB" for p in "AB"}


def test_normalised_matrix(pairs):
    shares = ev.confusion_matrix_norm(ev.confusion_matrix(pairs, "t", "p", LABELS)).collect()
    for label in LABELS:
        total = sum(r.share for r in shares if r.y_true == label)
        assert math.isclose(total, 1.0 if any(t == label for t, _ in PAIRS) else 0.0)


def test_report(pairs):
    report = {r.label: r for r in ev.classification_report(pairs, "t", "p").collect()}
    assert report["C"].precision == report["C"].recall == report["C"].f1 == 1.0
    assert report["D"].precision == report["D"].f1 == 0.0 and report["E"].recall == 0.0
    assert report["A"].precision == 5 / 8 and report["A"].recall == 5 / 8
    accuracy = sum(t == p for t, p in PAIRS) / len(PAIRS)
    assert math.isclose(report["accuracy"].f1, accuracy)
    assert math.isclose(report["weighted avg"].recall, accuracy)
    classes = [report[x] for x in "ABCDE"]
    assert sum(r.support for r in classes) == report["macro avg"].support == len(PAIRS)
    assert math.isclose(report["macro avg"].f1, sum(r.f1 for r in classes) / 5)


def test_multilabel(pairs):
    for r in ev.multilabel_confusion(pairs, "t", "p").collect():
        assert r.tp == sum(t == p == r.label for t, p in PAIRS)
        assert r.fp == sum(p == r.label != t for t, p in PAIRS)
        assert r.fn == sum(t == r.label != p for t, p in PAIRS)
        assert r.tn + r.tp + r.fp + r.fn == len(PAIRS)


def test_count_differences(pairs):
    months = pairs.withColumn("m", F.lit("2024-01"))
    total = {r.label: (r.n_true, r.n_pred, r["diff"]) for r in ev.count_difference(months, "m", "t", "p", False).collect()}
    assert total["A"] == (9, 9, 0) and total["E"] == (0, 1, -1) and total["D"] == (2, 0, 2)
    wrong = {r.label: (r.n_true, r.n_pred) for r in ev.count_difference(months, "m", "t", "p", True).collect()}
    assert wrong["A"] == (4, 4) and wrong["B"] == (1, 2) and "C" not in wrong


def test_abs_error(pairs):
    got = ev.abs_count_error(pairs.where("t IS NOT NULL AND p IS NOT NULL"), "t", "p").collect()[0]
    expected = sum(abs(sum(t == x for t, _ in PAIRS) - sum(p == x for _, p in PAIRS)) for x in LABELS)
    assert (got.abs_diff, got.total) == (expected, len(PAIRS))


def test_split_hash_is_stable_when_rows_are_added(spark):
    def split(n):
        keys = spark.range(n).select(F.col("id").cast("string").alias("k"))
        return {r.k: r.split for r in ds.split_hash(keys, "k").collect()}

    small, large = split(500), split(3000)
    assert all(large[k] == s for k, s in small.items())
    assert abs(sum(s == "train" for s in large.values()) / 3000 - 0.7) < 0.05
    with pytest.raises(ValueError):
        ds.split_hash(spark.range(1), "id", proportions=(0.5, 0.2, 0.1))


@pytest.mark.parametrize("test_size", [0.1, 137, 0.25])
def test_split_exact_sizes(spark, test_size):
    # a third of all rows share one key; they stay on one side
    keys = spark.range(1500).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string").alias("k"))
    out = ds.split_exact(keys, "k", test_size)
    got = {r.split: r.n for r in out.groupBy("split").agg(F.count("k").alias("n")).collect()}
    assert (got["train"], got["valid"], got["test"]) == ds.expected_sizes(1001, test_size)
    again = ds.split_exact(keys.repartition(3), "k", test_size)
    assert out.exceptAll(again).count() == 0 and out.select("k").distinct().count() == 1001


def test_split_exact_is_ranked_by_hash(spark):
    import hashlib

    keys = [str(i) for i in range(400)]
    order = sorted(keys, key=lambda k: (hashlib.md5(f"42#{k}".encode()).hexdigest(), k))
    out = ds.split_exact(spark.createDataFrame([(k,) for k in keys], "k string"), "k", 50)
    assert {r.k for r in out.where("split = 'test'").collect()} == set(order[:50])


def test_sample_repeats(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    first = [r.k for r in ds.seeded_sample(keys, "k", 20, seed=1).collect()]
    assert first == [r.k for r in ds.seeded_sample(keys.repartition(7), "k", 20, seed=1).collect()]
    assert first != [r.k for r in ds.seeded_sample(keys, "k", 20, seed=2).collect()]


def test_mask_dictionary(spark):
    keys = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    dictionary = pv.mask_dictionary(keys, "k", "secret")
    assert dictionary.count() == 2
    stats = pv.mask_collisions(dictionary).collect()[0]
    assert (stats.n_keys, stats.n_masks, stats.colliding_keys) == (2, 2, 0)


def test_seeded_sample_is_the_head_of_the_hash_order(rows):
    from caselabel.operators.datasets import key_hash, seeded_sample

    frame = rows("k string", *[(f"k{i}",) for i in range(3000)], ("k1",), (None,))
    order = [r.k for r in frame.orderBy(key_hash(F.col("k"), 5), "k").where("k IS NOT NULL").collect()]
    for n in (0, 1, 40, 5000):
        got = [r.k for r in seeded_sample(frame.where("k IS NOT NULL"), "k", n, seed=5).collect()]
        assert got == order[:n]
