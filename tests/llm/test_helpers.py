import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from caselabel.llm import samples, tables
from caselabel.llm import words as wd
from caselabel.llm.components import components


@pytest.mark.parametrize("kind", ["random", "chain", "star", "empty"])
def test_components(spark, kind):
    rnd = random.Random(3)
    pairs = {
        "random": [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)],
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(200)] + [(7, 7)],
        "empty": [],
    }[kind]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = [p for p in pairs if p[0] != p[1]]
    assert got == brute.least_reachable({n for p in linked for n in p}, linked)


def test_hot_join_is_an_inner_join(spark):
    rnd = random.Random(1)
    left = [(rnd.choice(["hot"] * 60 + [f"k{i}" for i in range(40)]), i) for i in range(2000)]
    counts = {}
    for k, _ in left:
        counts[k] = counts.get(k, 0) + 1
    right = [(k, n, f"v-{k}") for k, n in counts.items() if k != "k3"] + [("absent", 0, "v")]
    frames = spark.createDataFrame(left, "k string, i int"), spark.createDataFrame(right, "k string, n long, v string")
    for share in (1, 10, 1000):
        got = sorted(map(tuple, tables.hot_join(*frames, ["k"], "n", len(left), share).collect()))
        assert got == sorted((k, i, f"v-{k}") for k, i in left if k != "k3")


def test_bounded_sample(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 50 == 0, "rare").when(F.col("id") % 3 == 0, None).otherwise("often").alias("s"))
    one, two = (sorted(map(tuple, samples.bounded_sample(x, "s", 80, 200).collect())) for x in (df, df.repartition(5)))
    assert one == two
    sizes = {s: sum(r[1] == s for r in map(lambda r: (r[0], r[1]), [(x[1], x[0]) for x in one])) for s in ("rare", "often")}
    assert sizes == {"rare": 80, "often": 80}
    assert len(samples.bounded_sample(df, "s", 80, 60).collect()) == 60


def test_words_and_shingles_against_plain_ones():
    rnd = random.Random(4)
    texts = ["".join(rnd.choices("aB é\t\n\x0b-", k=rnd.randrange(0, 40))) for _ in range(300)] + ["", None, "x", "A a"]
    data, offsets = wd.buffers(pa.array(texts))
    found = wd.words(data, offsets)
    plain = [brute.WORD.findall(brute.fold(t or "")) for t in texts]
    assert np.diff(found.first).tolist() == list(map(len, plain))
    flat = [w for p in plain for w in p]
    same = {}
    for w, h in zip(flat, found.hash.tolist(), strict=True):
        assert same.setdefault(w, h) == h
    assert len(set(same.values())) == len(same)
    for k in (1, 2, 3, 5):
        hashes, first = wd.shingles(found, k)
        seen = {}
        for i, p in enumerate(plain):
            want = [tuple(p[j : j + k]) for j in range(len(p) - k + 1)] or ([tuple(p)] if p else [])
            own = hashes[first[i] : first[i + 1]].tolist()
            assert len(own) == len(want)
            for s, h in zip(want, own, strict=True):
                assert seen.setdefault(s, h) == h
        assert len(set(seen.values())) == len(seen)


def test_slices_cover_all_rows_once():
    offsets = np.array([0, 5, 5, 40, 41, 100, 100])
    parts = list(wd.slices(offsets, 10))
    assert [a for a, _ in parts] == [0, *[b for _, b in parts[:-1]]] and parts[-1][1] == 6
