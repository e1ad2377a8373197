"""Key sets, deduplication, row differences, column names, joins."""

import itertools
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from caselabel.operators import aggregates as ag
from caselabel.operators import columns as cl
from caselabel.operators import joins as jn
from caselabel.operators import keys as ky


def test_dedupe_last(rows):
    frame = rows("k string, o int, v string", ("a", 1, "x"), ("a", 3, None), ("a", 2, "y"), (None, 1, "n"), (None, 2, "m"), ("b", None, "z"))
    out = ky.dedupe_last(frame, ["k"], [F.col("o")])
    assert out.columns == ["k", "o", "v"]
    assert {r.k: (r.o, r.v) for r in out.collect()} == {"a": (3, None), None: (2, "m"), "b": (None, "z")}


def test_dedupe_last_needs_no_window_and_reduces_before_the_shuffle(spark):
    # one key holds a third of all rows
    frame = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    out = ky.dedupe_last(frame, ["k"], [F.col("o")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan
    assert out.count() == 20_001 and out.where("k = -1").collect()[0].o == 29_997


def test_flag_and_sets(rows):
    frame = rows("k string", ("a",), ("b",), ("b",), (None,))
    earlier = rows("k string", ("b",), (None,))
    assert {(r.k, r.is_new) for r in ky.flag_new(frame, earlier, "k").collect()} == {("a", True), ("b", False), (None, True)}
    assert [r.k for r in ky.anti_new_keys(frame, earlier, key="k").orderBy("k").collect()] == [None, "a"]
    assert [r.k for r in ky.key_difference(frame, earlier, "k").collect()] == ["a"]
    assert {r.k for r in ky.key_intersection(frame, earlier, "k").collect()} == {"b", None}


@pytest.mark.parametrize("which", [None, "both", "left_only", "right_only"])
def test_row_difference_against_a_joined_comparison(rows, which):
    left = [("a", 1), ("a", 1), (None, 2), ("b", None), ("c", 3), (None, None)]
    right = [("a", 1)] * 3 + [(None, 2), ("b", None), ("d", 4), (None, None), (None, None)]
    out = ky.row_difference(rows("x string, y int", *left), rows("x string, y int", *right), which)
    got = Counter({(r.x, r.y, r["_merge"]): max(r.n_left, 1) * max(r.n_right, 1) for r in out.collect()})
    as_object = [pd.DataFrame(d, columns=["x", "y"]).astype(object).where(lambda f: f.notna(), None) for d in (left, right)]
    merged = as_object[0].merge(as_object[1], how="outer", indicator=True)
    merged = merged[merged["_merge"] != "both"] if which is None else merged[merged["_merge"] == which]
    expected = Counter((None if pd.isna(x) else x, None if pd.isna(y) else int(y), m) for x, y, m in merged.itertuples(index=False))
    assert got == expected


def test_overlap_matrix(rows):
    sets = {"a": {"1", "2", "3"}, "b": {"2", "3"}, "c": {"9"}}
    frames = {n: rows("k string", *[(k,) for k in ks], (sorted(ks)[0],)) for n, ks in sets.items()}
    got = {(r.left_set, r.right_set): (r.in_both, r.left_only, r.contained) for r in ky.overlap_matrix("k", **frames).collect()}
    for x, y in itertools.permutations(sets, 2):
        assert got[x, y] == (len(sets[x] & sets[y]), len(sets[x] - sets[y]), sets[x] <= sets[y])


def test_leak(rows):
    train, test = rows("k string", ("a",), ("b",)), rows("k string", ("b",), ("c",), (None,))
    assert [r.k for r in ky.leaked_keys(train, test, "k").collect()] == ["b"]
    with pytest.raises(ValueError):
        ky.assert_no_leak(train, test, "k")
    ky.assert_no_leak(train, rows("k string", ("c",)), "k")


def test_duplicate_stats_of_nothing(rows):
    out = ky.duplicate_stats(rows("k string", ("a",)).limit(0), ["k"]).collect()[0]
    assert (out.n_rows, out.n_keys, out.duplicated_rows, out.extra_copies, out.duplicated_pct) == (0, 0, 0, 0, None)


def test_column_names(rows):
    assert cl.strip_prefix("d_relato_Ñ") == "RELATO_Ñ" and cl.strip_prefix("mes_f_x") == "X"
    with pytest.raises(ValueError):
        cl.strip_prefix("relato")
    assert cl.camel_case("cantidad_palabras") == "cantidadPalabras" and cl.camel_case("Tipo-Delito_PJ") == "tipoDelitoPj"
    frame = rows("k int, a_actual int, b int", (1, 2, 3))
    assert cl.strip_suffix_columns(frame, "_actual").columns == ["k", "a", "b"]
    assert cl.suffix_columns(frame, "_c", ["k"]).columns == ["k", "a_actual_c", "b_c"]


def test_left_enrich_keeps_row_count(rows):
    left = rows("k string, a int", ("x", 1), ("x", 2), ("y", 3), (None, 4))
    right = rows("k string, v string", ("x", "p"), ("x", "q"), (None, "n"))
    out = jn.left_enrich(left, right, "k", [F.col("v")])
    assert {(r.k, r.a, r.v) for r in out.collect()} == {("x", 1, "q"), ("x", 2, "q"), ("y", 3, None), (None, 4, None)}


def test_salted_enrich_gives_the_same_rows(spark):
    # one key holds a third of the left rows
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    plain, salted = (jn.left_enrich(left, right, "k", [F.col("v")], salt=n) for n in (1, 8))
    assert salted.columns == plain.columns and salted.count() == 3000
    assert ky.row_difference(plain, salted).count() == 0


def test_left_override_copies_null(rows):
    left = rows("k string, a string, b int", ("x", "old", 1), ("y", "old", 2))
    right = rows("k string, a string", ("x", "new"))
    out = jn.left_override(left, right, "k", ["a"], [F.col("a")])
    assert {(r.k, r.a, r.b) for r in out.collect()} == {("x", "new", 1), ("y", None, 2)}


def test_histogram_of_one_value(rows):
    out = ag.histogram(rows("x int", (7,), (7,), (None,)), "x", 10).collect()
    assert [(r.bin, r.low, r.high, r.n) for r in out] == [(0, 7.0, 7.0, 2)]


def test_describe_against_numpy(rows):
    numbers = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]
    frame = rows("x int", *[(n,) for n in numbers], (None,))
    got, s = ag.describe(frame, "x").collect()[0], pd.Series(numbers)
    assert got.n == len(numbers) and abs(got["mean"] - s.mean()) < 1e-12 and abs(got["std"] - s.std()) < 1e-9
    assert (got["min"], got["q1"], got["median"], got["q3"], got["max"]) == (1, *s.quantile([0.25, 0.5, 0.75]), 9)


def test_share_text(rows):
    frame = rows("l string, k string", ("a", "1"), ("b", "2"), ("b", "3"), ("b", "4"), ("c", "5"), ("c", "6"), ("c", "7"), ("c", "8"))
    assert {r.label: r.percentage for r in ag.category_share(frame, "l", "k").collect()} == {"a": "12.50%", "b": "37.50%", "c": "50.00%"}


def test_crosstab_order(rows):
    frame = rows("label string, TOTAL int", ("a", 1), ("TOTAL", 9), ("b", 5), ("c", 3))
    assert [r.label for r in ag.crosstab_sorted(frame, "label").collect()] == ["b", "c", "a", "TOTAL"]
