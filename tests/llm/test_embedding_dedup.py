import numpy as np
import pytest

import brute
from caselabel.llm import embedding_dedup as ed


def plain(rows, bar=0.93):
    """{place: (n_links, component)} by comparing all pairs."""
    ok = []
    for i, v, label in rows:
        good = v is not None and len(v) > 0 and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(np.array(v, float) if good else None)
    links = [0] * len(rows)
    pairs = []
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] is None or ok[b] is None or rows[a][2] != rows[b][2] or len(ok[a]) != len(ok[b]):
                continue
            if ok[a] @ ok[b] / (np.linalg.norm(ok[a]) * np.linalg.norm(ok[b])) >= bar:
                links[a] += 1
                links[b] += 1
                pairs.append((b, a))
    comp = brute.least_reachable(range(len(rows)), pairs)
    least = {}
    for place, c in comp.items():
        if rows[place][0] is not None:
            least[c] = min(least.get(c, 1 << 62), rows[place][0])
    return sorted(((r[0], n, least.get(comp[p])) for p, (r, n) in enumerate(zip(rows, links, strict=True))), key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = ed.near_duplicates(df, **options).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)


def clusters(n, dim, seed, spread=0.08, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(1, n // 6), dim))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = centres[rng.integers(len(centres))] + spread * rng.standard_normal(dim) * rng.choice([0.3, 1, 2])
        rows.append((int(rng.permutation(10 * n)[0]) * n + i, v.astype(np.float32).tolist(), label))
    return rows


def test_small_groups_are_exact(spark):
    rows = clusters(300, 16, 1)
    assert run(spark, rows) == plain(rows)


def test_odd_rows(spark):
    v, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [
        (5, v, 1), (4, v, 1), (9, v, 2), (8, v, None), (7, None, 1), (6, [], 1), (3, [0.0, 0.0, 0.0], 1), (2, [nan, 1.0, 1.0], 1),
        (1, [inf, 1.0, 1.0], 1), (10, [None, 1.0, 1.0], 1), (11, [2.0, 4.0, 6.0], 1), (12, [1.0, 2.0], 1), (13, [-1.0, -2.0, -3.0], 1),
        (14, v, 1), (14, v, 1), (None, v, 2), (None, [9.0, 0.0, -1.0], 2),
    ]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []


def test_hot_group_of_copies(spark):
    rows = [(i, [1.0, 0.5, 0.25], 1) for i in range(3000)] + [(9000, [1.0, 0.52, 0.25], 1)]
    got = run(spark, rows)
    assert {r[1] for r in got} == {3000} and {r[2] for r in got} == {0}


def test_forest_recall(spark, monkeypatch):
    monkeypatch.setattr(ed, "MAX_LEAF", 120)
    monkeypatch.setattr(ed, "LEAF", 60)
    rows = clusters(2500, 32, 2, labels=1)
    got, want = run(spark, rows), plain(rows)
    links, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True))
    assert links >= 0.97 * true
    assert sum(a[2] == b[2] for a, b in zip(got, want, strict=True)) >= 0.97 * len(rows)


@pytest.mark.parametrize("block", [32, 1024])
def test_dense_leaf_is_compared_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(ed, "MAX_LEAF", 100)
    monkeypatch.setattr(ed, "LEAF", 50)
    monkeypatch.setattr(ed, "BLOCK", block)
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + 0.1 * rng.standard_normal(16)).tolist(), 1) for i in range(400)]
    rows += [(1000 + i, rng.standard_normal(16).tolist(), 1) for i in range(300)]
    got, want = run(spark, rows), plain(rows)
    links, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.95 * true <= links <= true


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1, 2, 3), (2, [1.0, 0.0], 1, 2, 3)], "vec_id long, embedding array<double>, label int, cid int, links int")
    assert sorted(map(tuple, ed.near_duplicates(df).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]
