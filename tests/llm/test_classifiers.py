"""Toxicity and quality: held-out accuracy, and what the parts compute."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from caselabel.llm import quality as ql
from caselabel.llm import toxicity as tx

TABLES = "/root/testdata/sf0.1"


def held_out(rows, label):
    rows = [r for r in rows if r.held_out]
    truth = np.array([r[label] for r in rows])
    score = np.array([r.score for r in rows])
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    rank = np.argsort(np.argsort(score))
    area = (rank[truth == 1].mean() - (truth.sum() - 1) / 2) / (truth == 0).sum()
    return np.mean([r.predicted == t for r, t in zip(rows, truth, strict=True)]), area


def test_toxicity_on_given_documents(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    accuracy, area = held_out(tx.toxicity(docs, labels).join(labels, "doc_id").collect(), "toxic")
    assert accuracy > 0.95 and area > 0.93


def test_quality_on_given_documents(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    accuracy, area = held_out(ql.quality(docs, labels).join(labels, "doc_id").collect(), "quality")
    assert accuracy > 0.98 and area > 0.99


@pytest.mark.parametrize("run, label", [(tx.toxicity, "toxic"), (ql.quality, "quality")])
def test_odd_rows_and_labels(spark, run, label):
    rnd = random.Random(1)
    say = lambda bad: " ".join(rnd.choice(["scum", "idiot"]) + "!!" if bad and rnd.random() < 0.3 else rnd.choice(["tree", "house", "water", "stone", "garden"]) for _ in range(40))
    rows = [(i, say(i % 2), i % 2) for i in range(120)]
    docs = [(i, t, "x", 1) for i, t, _ in rows]
    docs += [(900, None, "x", 1), (901, "", "x", 1), (902, " \n", "x", 1), (903, "stone " * 40_000, "x", 1), (904, "garden", "x", 1), (904, "garden", "x", 1), (None, "house", "x", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string, label int")
    marks = [(i, b) for i, _, b in rows] + [(900, 1), (901, 0), (5, None), (None, 1), (7000, 1), (3, 1), (3, 1), (904, 0)]
    labels = spark.createDataFrame(marks, f"doc_id long, {label} int")
    out = run(df, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    again = run(df, labels).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert run(df.limit(0), labels).collect() == []
    assert {r.score for r in run(df, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in run(df, labels.where(f"{label} = 1")).collect()} == {1.0}
    # Labels of the held-out fold change nothing.
    flipped = spark.createDataFrame([(i, 1 - b if i is not None and b is not None and zlib.crc32(str(i).encode()) % 5 == 0 else b) for i, b in marks], f"doc_id long, {label} int")
    assert sorted(map(str, run(df, flipped).collect())) == sorted(map(str, got))


def test_windows_hold_every_word_once():
    texts = ["One  two\nthree four five", "", "six", " \t "]
    data, offsets = tx.wd.buffers(pa.array(texts))
    raw, segments, first = tx.windows(data, offsets, b"PRIMER")
    seen = [raw[int(a) : int(a + n) : 2].decode() for a, n in segments]
    assert [s.removeprefix("PRIMER").removesuffix("PRIMER") for s in seen] == [" one  two ", " three four ", " five ", " six "]
    assert first.tolist() == [0, 3, 3, 4, 4]


def test_toxic_dictionary_shortens_toxic_windows():
    rnd = random.Random(4)
    ordinary_words = ["".join(rnd.choices(["an", "re", "th", "on", "ti", "ou"], k=rnd.randrange(1, 5))).encode() for _ in range(2000)]
    ordinary = [rnd.choices(ordinary_words, k=60) for _ in range(80)]
    toxic = [rnd.choices(ordinary_words, k=55) + [b"blighter", b"wretchful"] for _ in range(80)]
    model = tx.train(toxic, ordinary)
    data, offsets = tx.wd.buffers(pa.array([b"blighter ouan".decode(), "reth wretchful", "anreth ouon", "thon tiou"]))
    counts = model.differences(data, offsets)
    gap = (counts * np.arange(tx.BINS)).sum(axis=1)
    assert gap[0] >= 4 and gap[1] >= 4 and gap[2] <= 1 and gap[3] <= 1


def test_contrasting_beginnings_are_chosen_greedily():
    toxic = [{b" grumbl" + s + b" " for s in (b"a", b"ing", b"ed")} | {b" tree "} for _ in range(10)]
    ordinary = [{b" tree ", b" green "} for _ in range(10)]
    assert tx.toxic_parts(toxic, ordinary) == [b" grumbl"]


def test_quality_features_by_hand():
    x = dict(zip(ql.NAMES, ql.features(pa.array(["Aa bb bb | 12!\nÉé bb"]))[0], strict=True))
    assert x["repeats"] == pytest.approx(1 / 7) and x["distinct"] == pytest.approx(5 / 7)
    assert x["signs_alone"] == pytest.approx(1 / 7) and x["capital_words"] == pytest.approx(1 / 7)
    assert x["share_line"] == pytest.approx(1 / 22) and x["accented_capitals"] == pytest.approx(1 / 22)
    assert np.isfinite(ql.features(pa.array(["", " ", "\n\n", None]))).all()


def test_pairwise_ranking_finds_the_direction():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 4))
    label = (x[:, 1] - 0.5 * x[:, 3] + 0.1 * rng.standard_normal(600) > 0.3).astype(int)
    model = ql.Model.fit(x, label, bad_share=float((label == 0).mean()))
    score = model.predict(x)
    assert np.mean((score >= ql.BAR) == (label == 1)) > 0.95
    assert model.weights[1] > 0 > model.weights[3]


def test_quality_is_learned_from_all_pairs():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((90, 3))
    label = (x[:, 0] - x[:, 2] + rng.standard_normal(90) > 0.4).astype(int)
    model = ql.Model.fit(x, label, bad_share=float((label == 0).mean()))
    z = (x - model.mean) / model.scale
    gap = (z[label == 1][:, None] - z[label == 0][None]).reshape(-1, 3)
    chance = 1 / (1 + np.exp(gap @ model.weights))
    slant = (chance[:, None] * gap).mean(axis=0) - ql.RIDGE * model.weights
    assert np.abs(slant).max() < 5e-3 and model.weights[0] > 0.5 > -0.5 > model.weights[2]
    assert ((model.predict(x) < ql.BAR).sum()) == (label == 0).sum()


def test_quality_counts_every_labelled_document(spark):
    rnd = random.Random(9)
    word = lambda bad: rnd.choice(["SPAM", "buy!!", "tree"]) if rnd.random() < (0.5 if bad else 0.2) else rnd.choice(["house", "water", "stone", "garden", "of", "to"])
    rows = [(i, " ".join(word(i % 9 == 0) for _ in range(rnd.randrange(8, 30))), int(i % 9 != 0)) for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    out = ql.quality(df.select("doc_id", "text"), df.select("doc_id", "quality")).collect()
    bad = {r[0] for r in rows if r[2] == 0}
    trained = [r for r in out if not r.held_out]
    assert len(out) == 9000 and len(trained) > 2 * 2000
    # The bar is the quantile of all documents learned from, not of a sample's.
    assert abs(sum(r.predicted == 0 for r in trained) - sum(r.doc_id in bad for r in trained)) <= 1


def test_quality_sums_in_spark_are_those_in_memory(spark):
    rng = np.random.default_rng(2)
    x = rng.random((500, len(ql.NAMES)))
    label = (x[:, 3] + 0.3 * rng.standard_normal(500) > 0.4).astype(int)
    train = spark.createDataFrame([(int(b), r.tolist()) for b, r in zip(label, x, strict=True)], "label int, x array<double>").repartition(5)
    here, there = ql.Model.fit(x, label, 0.3), ql.Model.fit_sums(ql._held_in_spark(train), len(ql.NAMES), 0.3)
    assert here.predict(x).tolist() == there.predict(x).tolist()
