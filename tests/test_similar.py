"""The similarity join against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from caselabel.operators import similar as sm


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def score(a, b):
    longest = max(len(a), len(b))
    return 100 if not longest else int(100 * (1 - distance(a, b) / longest) + 0.5)


def misspelt(word, rng, edits, letters):
    for _ in range(edits):
        at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
        word = word[:at] + ("" if kind == 0 else rng.choice(letters)) + word[at + (kind != 1) :]
    return word


def labels(seed, letters, n=120, longest=30):
    rng = random.Random(seed)
    base = ["".join(rng.choices(letters, k=rng.randrange(1, longest))) for _ in range(n)]
    return base, [misspelt(w, rng, rng.randrange(5), letters) for w in base] + base[:10]


@pytest.mark.parametrize("letters", ["ab", "abcdefgh ", "añü 的\u0001x"])
@pytest.mark.parametrize("bar", [67, 74, 75, 85, 99])
def test_pairs_against_all_pairs(spark, letters, bar):
    left, right = labels(bar, letters)
    a = spark.createDataFrame([(x,) for x in [*left, None, "", "aaaaaaaaaaaa"]], "x string")
    b = spark.createDataFrame([(x,) for x in [*right, None, "", "aaaaaaaaaaab"]], "y string")
    got = {(r.left, r.right, r.score) for r in sm.similar_pairs(a, "x", b, "y", bar).collect()}
    want = {(x, y, score(x, y)) for x in {*left, "", "aaaaaaaaaaaa"} for y in {*right, "", "aaaaaaaaaaab"}}
    assert got == {p for p in want if p[2] > bar}


def test_a_repeated_gram_may_move_far(spark):
    """The one edit spoils the first of two equal q-grams, so the other one is what both labels share."""
    pairs = [("menteieue", "menteueue"), ("abababababab", "ababxbababab"), ("aaaaaaaaaaaaaa", "aaaaaaaaaaaaa")]
    a, b = (spark.createDataFrame([(p[i],) for p in pairs], "x string") for i in (0, 1))
    got = {(r.left, r.right) for r in sm.similar_pairs(a, "x", b, "x", 85).collect()}
    assert got >= set(pairs)


def test_best_match_and_ties(spark):
    a = spark.createDataFrame([("ROBO A PERSONAS",), ("ROBO A PERSONA",), ("ASESINATO",), (None,), ("ROBO A PERSONA",)], "x string")
    b = spark.createDataFrame([("ROBO A PERSONAS",), ("ROBO A PERSONAX",), ("ROBO A PERSONAB",)], "y string")
    got = {r.x: (r.match, r.score) for r in sm.best_matches(a, "x", b, "y").collect()}
    assert got == {"ROBO A PERSONAS": ("ROBO A PERSONAS", 100), "ROBO A PERSONA": ("ROBO A PERSONAB", 93), "ASESINATO": ("No match found", None)}


def test_few_candidates_and_no_pairs_of_all(spark):
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(8, 20))) for _ in range(4000)]
    a = spark.createDataFrame([(misspelt(w, rng, 1, "abcxyz"),) for w in words], "label string").distinct()
    b = spark.createDataFrame([(w,) for w in words[:1000]], "label string").distinct()
    pairs = sm.candidate_pairs(a, b, 85)
    assert pairs.count() < 0.01 * 4000 * 1000
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoop|Python", plan)


def test_bars_without_long_enough_prefixes_are_refused(spark):
    empty = spark.createDataFrame([], "label string")
    for bar in (50, 66, 100):
        with pytest.raises(ValueError):
            sm.candidate_pairs(empty, empty, bar)
    assert sm.similar_pairs(empty, "label", empty.withColumn("o", F.lit(1)), "label").count() == 0
