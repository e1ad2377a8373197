"""Merkle manifest against a plain one."""

import random

import pytest
from brute import merkle_manifest

from caselabel.llm import merkle

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def want(rows, **options):
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return sorted(merkle_manifest([dict(zip(names, r, strict=True)) for r in rows], **options), key=str)


def docs(n, langs, seed=1):
    rng = random.Random(seed)
    return [(i * 3, rng.choice("ab"), rng.choice(langs), rng.choice([None, rng.randrange(99)]), "é" * rng.randrange(5)) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 9, 70])
def test_trees_of_any_size(spark, n):
    rows = docs(n, ["en", "fr", None, "de"] if n > 3 else ["en"])
    assert found(merkle.manifest(spark.createDataFrame(rows, COLUMNS), levels=3)) == want(rows)


def test_many_languages_and_a_wider_fanout(spark):
    rows = docs(60, [f"l{i}" for i in range(20)])
    assert found(merkle.manifest(spark.createDataFrame(rows, COLUMNS), fanout=3, levels=1)) == want(rows, fanout=3)


def test_tampered_rows_and_only_they_fail(spark):
    rows = [(i, "s", "en", i, "t") for i in range(40)]
    out = {r.doc_id: r.verified for r in merkle.manifest(spark.createDataFrame(rows, COLUMNS)).collect()}
    tampered = {r[0] for r in want(rows) if not r[-1]}
    assert tampered and {i for i, ok in out.items() if not ok} == tampered


def test_odd_rows(spark):
    rows = [
        (None, None, None, None, None),
        (1, "s", None, 5, ""),
        (1, "s", None, 5, "repeated id"),
        (2, "s", "en", None, "null count"),
        (2, "s", "en", None, "null count"),
        (-7, "", "", -1, "x" * 3_000_000),
        (14, "s", "EN", (1 << 63) - 1, "largest count"),
    ]
    extra = spark.createDataFrame([(*r, 0, "x", "y") for r in rows], COLUMNS + ", idx int, tree string, leaf string")
    assert found(merkle.manifest(extra)) == want(rows)


def test_empty(spark):
    assert merkle.manifest(spark.createDataFrame([], COLUMNS)).collect() == []


def test_equal_rows_fall_into_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges would be put together again
    try:
        rows = [(5, "s", "en", 1, "same")] * 3000
        placed = merkle.numbered(spark.createDataFrame(rows, COLUMNS).repartition(8), ["doc_id"], "test-places")
        assert sorted(r.pos for r in placed.collect()) == list(range(3000))
        assert len(placed.inputFiles()) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
