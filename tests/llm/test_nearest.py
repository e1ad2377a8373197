"""Nearest neighbours against brute force; the parts of the search against plain versions."""

import math
from collections import defaultdict

import numpy as np
import pytest

from caselabel.llm import nearest as nn

DDL = "vec_id long, embedding array<float>"


def brute(rows, every, k):
    """``rows``: (vec_id, vector); {query_id: [score, vec_id]}, best first."""
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and nice(v)]
    out = {}
    for q, (i, a) in enumerate(rows):
        if i % every:
            continue
        found = []
        for c, (j, b) in enumerate(rows):
            if c != q and len(a) == len(b):
                x, y = a / np.abs(a).max(), b / np.abs(b).max()
                found.append((float(x @ y / math.sqrt(x @ x) / math.sqrt(y @ y)), j))
        out[i] = sorted(found, key=lambda f: (-round(f[0], 12), f[1]))[:k]
    return out


def nice(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out[r.query_id].append((r["rank"], r.score, r.vec_id))
    return out


def compare(df, want, exact=True):
    got = found(df)
    assert set(got) == {q for q, f in want.items() if f}
    hits = 0
    for q, rows in got.items():
        assert [r for r, *_ in rows] == list(range(1, len(want[q]) + 1))
        hits += len({i for *_, i in rows} & {i for _, i in want[q]}) / len(want[q])
        if exact:
            assert [i for *_, i in rows] == [i for _, i in want[q]]
            assert np.allclose([s for _, s, _ in rows], [s for s, _ in want[q]], atol=1e-12)
    return hits / len(got)


def clusters(n, dim, groups, spread, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim))
    rows = centres[rng.integers(groups, size=n)] + spread * rng.standard_normal((n, dim))
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


def test_recall_of_random_vectors(spark):
    """The hardest case: no vector is near another."""
    rows = clusters(3000, 32, 1, 50.0)
    df = spark.createDataFrame(rows, DDL)
    assert compare(nn.search(df, 20, cell=256, leaf=32, sample=1000), brute(rows, 20, 5), exact=False) >= 0.95


def test_clusters_are_found_and_most_cells_left_alone(spark):
    rows = clusters(4000, 32, 40, 0.1)
    df = spark.createDataFrame(rows, DDL)
    index = nn.Index(df, cell=128, leaf=32)
    assert index.trees[32].depth >= 4
    assert compare(index.nearest(df.where("vec_id % 20 = 0")), brute(rows, 20, 5), exact=False) >= 0.97


def test_low_confidence_looks_at_less():
    assert nn.reach(0.5, 10) < nn.reach(0.9, 10) < nn.reach(0.99, 10)
    assert abs(nn.chi_square(nn.reach(0.95, 10), 10) - 0.95) < 1e-9
    assert abs(nn.reach(0.95, 10) - 18.307) < 1e-3  # the tabled quantile
    draws = np.random.default_rng(1).standard_normal((200_000, 10))
    assert abs(np.mean((draws**2).sum(axis=1) < 12.0) - nn.chi_square(12.0, 10)) < 5e-3


def test_projections_keep_the_distribution():
    """Squared projected distance over squared distance is a chi-square variable."""
    rng = np.random.default_rng(2)
    a, b = (nn._units(rng.standard_normal((4000, 64))) for _ in range(2))
    # one pair of vectors under many directions is what the theorem speaks of
    gap = (a[0] - b[0]) @ rng.standard_normal((64, 10 * 4000))
    ratio = (gap.reshape(4000, 10) ** 2).sum(axis=1) / ((a[0] - b[0]) ** 2).sum()
    for q in (5.0, 9.0, 14.0):
        assert abs(np.mean(ratio < q) - nn.chi_square(q, 10)) < 0.03


def test_tree_cells_lie_in_their_boxes():
    rng = np.random.default_rng(3)
    tree = nn.Tree(rng.standard_normal((500, 4)), 5)
    more = rng.standard_normal((2000, 4)) * 3
    cells = tree.cells(more)
    assert (nn._box_distance(more, tree.low, tree.high)[np.arange(2000), cells] == 0).all()
    plain = [[sum(max(lo - x, 0, x - hi) ** 2 for x, lo, hi in zip(p, low, high)) for low, high in zip(tree.low, tree.high)] for p in more[:20]]
    assert np.allclose(nn._box_distance(more[:20], tree.low, tree.high), plain)


def test_leaves_hold_every_row_once():
    places = np.random.default_rng(4).standard_normal((1000, 3))
    places[:600] = places[0]  # equal places are halved like others
    leaves = nn._leaves(places, 50)
    assert max(map(len, leaves)) <= 50
    assert sorted(np.concatenate(leaves).tolist()) == list(range(1000))


def test_a_third_are_copies(spark):
    rows = clusters(900, 16, 30, 0.2)
    rows = [(i, rows[7][1]) if i % 3 == 0 else (i, v) for i, v in rows]
    df = spark.createDataFrame(rows, DDL)
    out = nn.Index(df, cell=64, leaf=16).nearest(df.where("vec_id % 20 = 0"), pack=4)
    want = brute(rows, 20, 5)
    assert compare(out, want, exact=False) >= 0.95
    copies = {q: f for q, f in want.items() if q % 3 == 0}
    compare(out.where("query_id % 3 = 0"), copies, exact=True)


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_fewer_candidates_than_asked_for(spark, n):
    rows = [(i * 50, [1.0, float(i)]) for i in range(n)]
    compare(nn.search(spark.createDataFrame(rows, DDL)), brute(rows, 50, 5)) if n > 1 else None
    assert nn.search(spark.createDataFrame(rows, DDL)).count() == n * max(n - 1, 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
        (None, [1.0, 2.0]), (50, [1e200, 2e200]), (100, [1e-200, 2e-200]), (7, [2.0, -1.0]), (8, [1.0, 1.0]),
        (150, [1.0, 2.0, 3.0]), (9, [3.0, 2.0, 1.0]), (200, [4.0]), (-50, [-1.0, -2.0]), (10, [1e-310, 2e-310]),
    ]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<double>, h1 int, place string, cell int")
    got = found(nn.search(df))
    want = brute(rows, 50, 5)
    assert set(got) == {q for q, f in want.items() if f} and 200 not in got
    for q in got:
        assert [round(s, 9) for _, s, _ in got[q]] == [round(s, 9) for s, _ in want[q]]
    assert [i for *_, i in got[150]] == [9]


def test_repeated_rows_count_once_and_rows_of_one_id_are_rows_each(spark):
    rows = [(0, [1.0, 0.0])] * 3 + [(1, [1.0, 0.1])] * 2 + [(0, [1.0, 0.2]), (2, [0.0, 1.0])]
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in nn.search(spark.createDataFrame(rows, DDL)).collect())
    assert got == sorted([(0, 1, 1), (0, 2, 0), (0, 3, 2)] * 2)


def test_an_odd_number_of_projections_is_refused(spark):
    with pytest.raises(ValueError):
        nn.Index(spark.createDataFrame([], DDL), dims=7)
