import hashlib
import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from caselabel.llm import mixing


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, epochs=2):
    """Give by weight, take back what is too much, give that again, until nothing is left over."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while free and left > 1e-9:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = sum(max(0.0, target[s] - epochs * sizes[s]) for s in free)
        for s in list(free):
            if target[s] >= epochs * sizes[s]:
                target[s] = float(epochs * sizes[s])
                free.discard(s)
    return target


def brute(rows, seed="mix", **options):
    sized = [(d, len(re.findall("[^\x20\x09-\x0d]+", t or "")), s) for d, t, s in rows]
    sizes = defaultdict(int)
    for _, n, s in sized:
        sizes[s] += n
    target = brute_targets(sizes, **options)
    out = []
    for source, size in sizes.items():
        order = sorted((hashlib.md5(f"{seed}:{'' if d is None else d}".encode()).hexdigest(), d or 0, n, d) for d, n, s in sized if s == source)
        left, taken = math.floor(target[source] + 1e-6), [0] * len(order)
        while left and size:
            for i, (_, _, n, _) in enumerate(order):
                step = min(n, left)
                taken[i] += step
                left -= step
        out += [(d, n, size, round(target[source], 6), t) for (_, _, n, d), t in zip(order, taken)]
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), **options)
    return sorted(map(tuple, df.withColumn("target", F.round("target", 6)).collect()), key=str)


ROWS = [(i, " ".join(["w"] * (i * 7 % 23)), f"s{i % 5}" if i % 4 else "s1") for i in range(200)]


@pytest.mark.parametrize("options", [{}, {"weights": (1,)}, {"share": 0.3}, {"share": 1.99}, {"share": 2.5, "epochs": 3}, {"weights": (1, 50)}])
def test_against_brute_force(spark, options):
    assert run(spark, ROWS, **options) == brute(ROWS, **options)


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "one two", None), (4, "x " * 5000, "É"), (None, "u v w", "a"), (5, "p", ""), (5, "p", ""), (6, "q r", "z")]
    assert run(spark, rows) == brute(rows)


def test_few_ranges_and_many_give_the_same(spark):
    assert run(spark, ROWS, range_digits=1) == run(spark, ROWS, range_digits=5)


def test_only_empty_texts(spark):
    assert [r[4] for r in run(spark, [(1, "", "a"), (2, None, "b")])] == [0, 0]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_other_columns_with_the_same_names(spark):
    df = spark.createDataFrame([(i, "a b c", "s", 1, 2, 3) for i in range(4)], "doc_id long, text string, source string, size int, target int, key int")
    got = mixing.mix(df)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert sum(r.taken for r in got.collect()) == 18
