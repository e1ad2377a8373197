"""Scoring that goes on where it was stopped."""

import pytest
from pyspark.sql import functions as F

from caselabel.plans import resumable
from caselabel.sources import keyed


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "cases")
    keyed.save_keyed(spark.range(400).selectExpr("concat('k', id) AS k", "id AS x"), path, "k", 12)
    return path, str(tmp_path / "results")


def double(df):
    return df.select("k", (F.col("x") * 2).alias("y"))


def results(spark, target):
    return sorted((r.k, r.y) for r in resumable.read_results(spark, target).collect())


WANT = sorted((f"k{i}", 2 * i) for i in range(400))


def test_whole_run_and_nothing_left(spark, table):
    source, target = table
    steps = resumable.run_resumable(spark, source, target, double, 12, per_step=5)
    assert [len(s) for s in steps] == [5, 5, 2] and results(spark, target) == WANT
    assert resumable.run_resumable(spark, source, target, double, 12, per_step=5) == []


@pytest.mark.parametrize("again", [5, 2, 12])
def test_stopped_run_scores_the_rest_only(spark, table, again):
    source, target = table
    calls = []

    def stops(df):
        calls.append(1)
        if len(calls) == 2:
            df.limit(1).select("k", F.lit(-1).cast("bigint").alias("y")).write.parquet(f"{target}/_step=5")  # half written
            raise RuntimeError("stopped")
        return double(df)

    with pytest.raises(RuntimeError):
        resumable.run_resumable(spark, source, target, stops, 12, per_step=5)
    assert resumable.finished_buckets(spark, target) == set(range(5))
    seen = []

    def watched(df):
        seen.extend(r.x for r in df.select("x").collect())
        return double(df)

    steps = resumable.run_resumable(spark, source, target, watched, 12, per_step=again)
    assert sorted(b for s in steps for b in s) == list(range(5, 12))
    assert results(spark, target) == WANT
    buckets = spark.range(400).select("id", keyed.bucket_of(F.concat(F.lit("k"), F.col("id")), 12).alias("b"))
    assert sorted(seen) == sorted(r.id for r in buckets.where("b >= 5").collect())


def test_the_scan_is_pruned(spark, table):
    source, target = table
    plans = []

    def looked_at(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return double(df)

    resumable.run_resumable(spark, source, target, looked_at, 12, per_step=6)
    assert all("PartitionFilters: [_bucket" in p for p in plans) and len(plans) == 2


def test_steps_need_a_bucket(spark, table):
    with pytest.raises(ValueError):
        resumable.run_resumable(spark, *table, double, 12, per_step=0)
