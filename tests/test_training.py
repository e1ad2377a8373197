"""Training in passes, and predictions against ones written out by hand."""

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from caselabel.operators import training as tr

WORDS = {"A": "uno dos tres cuatro", "B": "cinco seis siete ocho", "C": "nueve diez once doce"}


def texts(spark, n, seed, noise=0.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = rng.choice("ABC")
        words = [rng.choice(WORDS[label].split() if rng.random() > 0.4 else " ".join(WORDS.values()).split()) for _ in range(8)]
        words.append(f"w{rng.randrange(400)}")  # what can only be learned by heart
        rows.append((i, " ".join(words), rng.choice("ABC") if rng.random() < noise else label))
    return spark.createDataFrame([*rows, (n, None, "A"), (n + 1, "uno", None)], "k int, t string, y string")


@pytest.fixture(scope="module")
def trained(spark):
    return tr.train_until_it_stops_helping(
        texts(spark, 150, 1, noise=0.3), texts(spark, 150, 2), "t", "y", passes=15, iterations=4, patience=2, features=256
    )


def test_it_stops_early_and_keeps_the_best_pass(trained):
    valid = [row[2] for row in trained.history]
    assert [row[0] for row in trained.history] == list(range(1, len(valid) + 1))
    assert trained.best == 1 + int(np.argmin(valid)) and len(valid) == trained.best + 2 < 15
    train = [row[1] for row in trained.history]
    assert train[-1] < train[0]  # it went on learning by heart


def test_the_kept_model_has_the_loss_of_its_pass(spark, trained):
    rows = texts(spark, 150, 2)
    out = tr.predict_probability(rows.where("y IS NOT NULL"), trained.model, "t", "label", "p").collect()
    accuracy = np.mean([r.label == r.y for r in out])
    assert accuracy == pytest.approx(trained.history[trained.best - 1][3]) and accuracy > 0.8


def test_history_frame(spark, trained):
    rows = tr.pass_history(spark, trained).collect()
    assert [r["pass"] for r in rows if r.kept] == [trained.best] and len(rows) == len(trained.history)


def softmax(x):
    e = np.exp(x - x.max())
    return e / e.sum()


def test_probabilities_by_hand(spark, tmp_path):
    rows = texts(spark, 120, 3)
    model = tr.train_classifier(rows, "t", "y", features=128, iterations=15)
    learner = model.stages[-1]
    weights, bias = learner.coefficientMatrix.toArray(), learner.interceptVector.toArray()
    known = rows.where("t IS NOT NULL")
    vectors = {r.k: r._x.toArray() for r in tr.PipelineModel(model.stages[1:-1]).transform(known).collect()}
    for fitted in (model, tr.load_model(tr.save_model(model, str(tmp_path / "model")))):
        for r in tr.predict_probability(known, fitted, "t", "label", "p").collect():
            p = softmax(weights @ vectors[r.k] + bias)
            assert r.label == tr.class_labels(fitted)[int(p.argmax())] and r.p == pytest.approx(p.max(), abs=1e-9)


def test_passes_by_hand(spark, trained):
    learner = trained.model.stages[-1]
    flat = learner.weights.toArray()
    weights, bias = flat[: 256 * 3].reshape(3, 256, order="F"), flat[256 * 3 :]
    known = texts(spark, 60, 4).where("t IS NOT NULL")
    vectors = {r.k: r._x.toArray() for r in tr.PipelineModel(trained.model.stages[1:-1]).transform(known).collect()}
    for r in tr.predict_probability(known, trained.model, "t", "label", "p").collect():
        p = softmax(weights @ vectors[r.k] + bias)
        assert r.label == tr.class_labels(trained.model)[int(p.argmax())] and r.p == pytest.approx(p.max(), abs=1e-9)


def test_senseless_options_are_refused(spark):
    rows = texts(spark, 5, 5)
    with pytest.raises(ValueError):
        tr.train_until_it_stops_helping(rows, rows, "t", "y", patience=0)


def test_losses_of_both_parts_in_one_pass(spark, trained):
    """As Spark's evaluators have them, a scan a figure."""
    vectors = tr.PipelineModel(trained.model.stages[:-1]).transform(texts(spark, 90, 6).where("t IS NOT NULL AND y IS NOT NULL"))
    scored = trained.model.stages[-1].transform(vectors.withColumn("_part", F.col("k") % 2))
    loss = MulticlassClassificationEvaluator(labelCol="_y", predictionCol="_prediction", probabilityCol="_probability", metricName="logLoss")
    first, second = scored.where("_part = 0"), scored.where("_part = 1")
    expected = (loss.evaluate(first), loss.evaluate(second), loss.copy().setMetricName("accuracy").evaluate(second))
    assert tr._losses(scored) == pytest.approx(expected, abs=1e-12)
    assert tr._losses(first)[1:] == (0.0, 0.0)
