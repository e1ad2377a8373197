"""Keyed tables, masks that can be undone, quantiles by selection."""

import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from caselabel.functions import people as pp
from caselabel.operators import aggregates as ag
from caselabel.operators import privacy as pv
from caselabel.sources import keyed


def listing(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, files in os.walk(path) for f in files if f.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(f"k{i}", i, f"text {i}") for i in range(500)] + [(None, -1, "no key"), ("k7", 700, "second row of a key")]
    keyed.save_keyed(spark.createDataFrame(rows, "k string, a long, t string"), path, "k", 16)
    return path, rows


def stored(spark, path):
    return sorted(map(tuple, keyed.read_keyed(spark, path).collect()), key=str)


def update(spark, table, rows, journal, columns=("a",)):
    source = spark.createDataFrame(rows, "k string, a long, o int")
    return keyed.update_keyed(spark, table, source, "k", list(columns), [F.col("o")], 16, str(journal))


def test_only_touched_buckets_are_rewritten(spark, table, tmp_path):
    path, rows = table
    before = listing(path)
    touched = update(spark, path, [("k3", 33, 1), ("k7", 77, 1), ("k7", 78, 2), ("unknown", 5, 1), (None, 9, 1), ("k9", None, 1)], tmp_path / "j")
    after = listing(path)
    new = {"k3": 33, "k7": 78, "k9": None}
    assert stored(spark, path) == sorted(((k, new[k] if k in new else a, t) for k, a, t in rows), key=str)
    same = {f for f in before if before[f] == after.get(f)}
    changed = {int(re.search(r"_bucket=(\d+)", f).group(1)) for f in before.keys() - same}
    assert changed == set(touched) and 1 <= len(touched) <= 3 and len(same) >= 13


def test_nothing_found_rewrites_nothing(spark, table, tmp_path):
    path, rows = table
    before = listing(path)
    assert update(spark, path, [("unknown", 5, 1)], tmp_path / "j") == []
    assert update(spark, path, [], tmp_path / "k") == []
    assert listing(path) == before


def test_a_stopped_update_is_repeated_from_its_journal(spark, table, tmp_path, monkeypatch):
    path, rows = table
    journal = tmp_path / "j"
    want = sorted(((k, 1000 + a if k in ("k1", "k2", "k5") else a, t) for k, a, t in rows), key=str)
    source = [(f"k{i}", 1000 + i, 1) for i in (1, 2, 5)]
    touched = update(spark, path, source, journal)
    assert stored(spark, path) == want
    # stopped while a partition was being replaced: its files are half gone
    lost = next(f for f in sorted(listing(path)) if f"_bucket={touched[0]}/" in f)
    os.truncate(lost, 10)
    assert update(spark, path, source, journal) == touched
    assert stored(spark, path) == want
    # stopped before the journal was complete: nothing in the table had changed, and it starts anew
    again = tmp_path / "again"
    spark.createDataFrame([("x",)], "k string").write.parquet(str(again))
    assert update(spark, path, [("k3", 33, 1)], again) and ("k3", 33, "text 3") in stored(spark, path)


def test_the_scan_is_pruned_to_the_buckets(spark, table):
    path, rows = table
    few = spark.createDataFrame([("k3",), ("k3",), (None,), ("unknown",)], "k string")
    found = keyed.read_keyed(spark, path, "k", few, 16)
    assert [tuple(r) for r in found.collect()] == [("k3", 3, "text 3")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*_bucket", plan)


def test_a_table_with_the_bucket_column_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        keyed.save_keyed(spark.createDataFrame([("a", 1)], "k string, _bucket int"), str(tmp_path / "x"), "k", 4)


def test_masks_of_short_keys_are_a_permutation(spark):
    for width in (2, 3, 4):
        keys = spark.range(10**width).select(F.lpad(F.col("id").cast("string"), width, "0").alias("k"))
        masked = keys.withColumn("m", pp.masked_digits(F.col("k"), "s", width)).withColumn("back", pp.unmasked_digits(F.col("m"), "s", width))
        rows = masked.collect()
        assert {r.m for r in rows} == {r.k for r in rows} and all(r.back == r.k for r in rows)
        assert sum(r.m == r.k for r in rows) < 10**width / 5


def test_masks_of_long_keys_can_be_undone(spark):
    rng = random.Random(1)
    keys = ["0" * 15, "9" * 15, "000000000000001"] + [f"{rng.randrange(10**15):015}" for _ in range(2000)]
    frame = spark.createDataFrame([(k,) for k in keys], "k string")
    out = pv.unmask_key(pv.mask_key(frame, "k", "s", "m"), "m", "s", "back").collect()
    assert all(re.fullmatch(r"\d{15}", r.m) and r.back == r.k for r in out) and len({r.m for r in out}) == len(set(keys))
    other = pv.mask_key(frame, "k", "t", "m").collect()
    assert sum(a.m == b.m for a, b in zip(out, other, strict=True)) == 0


def test_masks_of_other_texts(spark):
    texts = ["12", "000000000000012x", "", "0000000000000012", None, "-00000000000012", "000000000000012"]
    out = pv.mask_key(spark.createDataFrame([(t,) for t in texts], "k string"), "k", "s", "m").collect()
    assert [len(r.m) if r.m else None for r in out] == [64, 64, 64, 64, None, 64, 15]
    assert len({r.m for r in out}) == len(texts)


def test_mask_rounds_against_plain_ones(spark):
    import hashlib

    def plain(key, secret):
        high, low = divmod(int(key), 10**8)
        for r in range(pp.ROUNDS):
            step = lambda other: int(hashlib.sha256(f"{secret}{r}:{other}".encode()).hexdigest()[:15], 16)
            if r % 2:
                low = (low + step(high)) % 10**8
            else:
                high = (high + step(low)) % 10**7
        return f"{high * 10**8 + low:015}"

    keys = [f"{i * 7_919_000_003:015}" for i in range(50)]
    out = pv.mask_key(spark.createDataFrame([(k,) for k in keys], "k string"), "k", "s", "m").collect()
    assert [r.m for r in out] == [plain(k, "s") for k in keys]


def quantile(values, q):
    values = sorted(values)
    at = q * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at))


@pytest.mark.parametrize(
    "values",
    [
        [1.5],
        [2.0, 1.0],
        [0.0, -0.0, 1e-320, -1e-320],
        [1e300, -1e300, 1.0, 2.0, 3.0],
        [float(i % 7) for i in range(1000)],
        [random.Random(5).gauss(0, 1) * 10 ** random.Random(i).randrange(-200, 200) for i in range(500)],
    ],
)
def test_quantiles_by_selection(spark, values):
    shares = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.77, "e": 1.0}
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(5)
    got = ag.exact_quantiles(frame, "x", shares).collect()[0]
    assert all(math.isclose(got[n], quantile(values, q), rel_tol=1e-12, abs_tol=1e-300) for n, q in shares.items())


def test_quantiles_of_nothing_and_of_integers(spark):
    nothing = ag.exact_quantiles(spark.createDataFrame([(None,)], "x double"), "x", {"m": 0.5}).collect()
    assert [r.m for r in nothing] in ([], [None])
    described = ag.describe(spark.createDataFrame([(None,)], "x double"), "x", distinct="many").collect()[0]
    assert described.n == 0 and described.median is None
    both = [ag.describe(spark.range(-50, 1001).selectExpr("id AS x"), "x", distinct=d).collect()[0].asDict() for d in ("few", "many")]
    assert all(math.isclose(both[0][c], both[1][c], rel_tol=1e-9) for c in both[0])
    with pytest.raises(ValueError):
        ag.describe(spark.range(3), "id", distinct="some")


def test_selection_shuffles_counts_not_values(spark):
    plan = ag.exact_quantiles(spark.range(100).selectExpr("id / 7 AS x"), "x", {"m": 0.5})._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange hashpartitioning\((.*?)\)", plan)
    assert exchanges and all("x#" not in e for e in exchanges)
