"""Incremental runs: keyed state, recovery, repeated keys."""

import pytest
from pyspark.sql import functions as F

from caselabel.streaming.incremental import run_available

SCHEMA = "k string, t string"


@pytest.fixture
def drop_folder(spark, tmp_path):
    """Write rows as one file that arrives, and pull what has arrived."""
    source, checkpoint = str(tmp_path / "in %41 é"), str(tmp_path / "checkpoint")

    def put(*rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def pull(target="out", process=lambda fresh: fresh, files=1, **options):
        return run_available(
            spark, source, SCHEMA, str(tmp_path / target), checkpoint, "k", [F.col("t")], process, files_per_batch=files, **options
        )

    def stored(target="out"):
        return sorted((r.k, r.t) for r in spark.read.parquet(str(tmp_path / target)).collect())

    return put, pull, stored


def test_last_row_of_the_first_batch_with_a_key_wins(drop_folder):
    put, pull, stored = drop_folder
    put(("a", "1"), ("a", "3"), ("a", "2"), ("b", "1"), (None, "no case"))
    pull()
    put(("a", "9"), ("c", "1"), ("c", "0"))
    pull()
    pull()
    assert stored() == [("a", "3"), ("b", "1"), ("c", "1")]


def test_a_key_in_several_files_of_one_batch(drop_folder):
    put, pull, stored = drop_folder
    put(("a", "1"), ("b", "1"))
    put(("a", "2"))
    put(("a", "0"), ("c", "5"))
    assert len(pull(files=10)) == 1
    assert stored() == [("a", "2"), ("b", "1"), ("c", "5")]


def test_keys_are_known_from_state_not_from_what_was_written(drop_folder):
    put, pull, stored = drop_folder
    put(("a", "1"), ("b", "1"))
    pull("first")
    put(("b", "2"), ("d", "2"))
    pull("second")  # another folder: nothing of the first run's output is there
    assert stored("second") == [("d", "2")]


def test_a_batch_that_failed_is_replayed(drop_folder):
    put, pull, stored = drop_folder
    put(("a", "1"))
    pull()
    put(("a", "2"), ("b", "2"))
    put(("b", "3"), ("c", "3"))

    def breaks(fresh):
        raise RuntimeError("stopped in the middle")

    with pytest.raises(Exception, match="stopped in the middle"):
        pull(process=breaks)
    pull()
    assert stored() == [("a", "1"), ("b", "2"), ("c", "3")]


def test_prepare_filters_and_renames(spark, drop_folder):
    put, pull, stored = drop_folder
    put(("a", "drop"), ("B", "keep"))
    put(("b", "keep later"), ("x", "drop"))
    pull(prepare=lambda df: df.where(~F.col("t").startswith("drop")).withColumn("k", F.lower("k")))
    assert stored() == [("b", "keep")]


def test_batches_cost_the_same_however_many_came_before(drop_folder):
    put, pull, stored = drop_folder
    for batch in range(6):
        put(*[(f"{i}", f"{batch}") for i in range(batch * 50, batch * 50 + 100)])  # half of each batch is known
    progress = pull()
    assert [p["stateOperators"][0]["numRowsUpdated"] for p in progress] == [101] * 6  # its keys and its file
    assert [p["stateOperators"][0]["numRowsTotal"] for p in progress] == [101 + 51 * i for i in range(6)]
    assert len(stored()) == 350


def test_the_session_keeps_its_settings(spark, drop_folder):
    put, pull, _ = drop_folder
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    put(("a", "1"))
    pull()
    assert spark.conf.get(name) == before
