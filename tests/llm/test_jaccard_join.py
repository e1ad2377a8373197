import random

import pytest

import brute
from caselabel.llm import jaccard_join as jj


def answer(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def near_copies(seed=3):
    """Documents of many lengths, with groups of copies that differ in a few words, chained and starred."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for length in (1, 2, 3, 9, 10, 11, 12, 13, 20, 25, 40, 60, 90, 150, 400, 1200):
        base = rnd.choices(vocabulary, k=length)
        for _ in range(12):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, max(1, length // 60), max(1, length // 40)])):
                copy[rnd.randrange(length)] = rnd.choice(vocabulary)
            rows.append(copy)
            if rnd.random() < 0.4:
                base = copy
    rnd.shuffle(rows)
    return [(7 * i % 1009, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("k, num, den", [(3, 90, 100), (3, 80, 100), (1, 70, 100), (5, 95, 100)])
def test_against_brute_force(spark, k, num, den):
    rows = near_copies()
    got = answer(jj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), k, num, den))
    assert got == brute.jaccard_components(rows, k, num, den)


def test_hot_group_of_copies_and_near_copies(spark):
    rnd = random.Random(5)
    base = rnd.choices([f"v{i}" for i in range(500)], k=80)
    texts = [" ".join(base)] * 400
    for i in range(400):
        copy = list(base)
        for _ in range(rnd.choice([1, 2, 3])):
            copy[rnd.randrange(80)] = f"n{i}"
        texts.append(" ".join(copy))
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    got = answer(jj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)))
    assert got == brute.jaccard_components(rows)


def test_blocks_are_compared_when_the_first_member_links_with_none(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK_SETS", 3)
    monkeypatch.setattr(jj, "SKETCH_BLOCK", 1000)
    rnd = random.Random(9)
    rows = []
    for g in range(6):
        base = [f"g{g}x{i}" for i in range(120)]
        for c in range(9):
            copy = list(base)
            for j in range(3):
                copy[(17 * (c // 3) + 5 * j) % 120] = f"g{g}c{c // 3}j{j}"
            copy[100 + c] = f"g{g}own{c}"
            rows.append((rnd.randrange(1 << 40), " ".join(copy)))
    got = answer(jj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute.jaccard_components(rows)


def test_odd_rows(spark):
    long_text = " ".join(f"t{i % 5000}a{i}" for i in range(60_000))
    rows = [
        (1, None, "a"), (2, "", "b"), (3, " \t\n", "c"), (4, "One two", "d"), (5, "one  TWO", "e"), (6, "one", "f"),
        (8, long_text, "g"), (7, long_text + " end", "h"), (9, "x y z w", "i"), (9, "x y z w", "j"), (9, "one two", "k"),
        (None, "one two", "l"), (None, "only here is this text", "m"),
    ]
    df = spark.createDataFrame([(i, t, c, 1, 2) for i, t, c in rows], "doc_id long, text string, cid string, key int, n int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.jaccard_components(df).collect()), key=str)
    n = 59_998
    want = [
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (8, n, 7), (7, n + 1, 7),
        (9, 2, 9), (9, 2, 9), (9, 1, 4), (None, 1, 4), (None, 3, None),
    ]
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jj.jaccard_components(df).collect() == []


def test_sketches_never_hide_a_link():
    rng = jj.np.random.default_rng(2)
    sim = jj.Similarity(80, 100)
    for _ in range(300):
        a = jj.np.unique(rng.integers(0, 1 << 60, rng.integers(1, 900), dtype=jj.np.uint64))
        b = jj.np.unique(jj.np.concatenate([rng.choice(a, max(1, int(len(a) * rng.uniform(0.7, 1))), replace=False), rng.integers(0, 1 << 60, rng.integers(0, 90), dtype=jj.np.uint64)]))
        common = len(jj.np.intersect1d(a, b))
        differ = len(a) + len(b) - 2 * common
        x, y = jj.sketch_of(a), jj.sketch_of(b)
        words = min(len(x), len(y))
        x, y = (jj.np.bitwise_xor.reduce(z.reshape(-1, words), axis=0) for z in (x, y))
        bits = int(jj.np.bitwise_count((x ^ y).view(jj.np.uint64)).sum())
        assert bits <= differ
        most, part = sim.apart(len(a) + len(b))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            assert bits * part <= most


def test_similarity_bounds_are_exact():
    sim = jj.Similarity(90, 100)
    for a in range(1, 400):
        linked = [b for b in range(a, 2 * a + 2) if 100 * a >= 90 * b]
        assert sim.largest(a) == max(linked)
        most = 0
        for b in linked:
            common = next(c for c in range(a + 1) if 100 * c >= 90 * (a + b - c))
            most = max(most, a + b - 2 * common)
        assert sim.differences(a) >= most


def test_one_row_of_each_component_stays(spark):
    rows = near_copies(8)
    comps = brute.jaccard_components(rows, 5, 80, 100)
    rows += [(2001, None), (2002, ""), (2002, ""), (None, rows[0][1])]
    same = " ".join(f"s{i}" for i in range(40))
    rows += [(3001, same), (3001, same), (3001, same + " end"), (3001, "another text under the same id here"), (3000, "not like any of the other ones")]
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, handle int, rank string")
    out = jj.keep_first(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    text = dict(rows)
    want = [(i, t) for i, t in near_copies(8) if comps[i][1] == i]
    want += [(2001, None), (2002, ""), (2002, ""), (None, rows[0][1]), (3000, text[3000])]
    under = [t for i, t in got if i == 3001]
    assert [g for g in got if g[0] != 3001] == sorted(want, key=str)
    assert len(under) == 1 and under[0] in {same, same + " end", "another text under the same id here"}
