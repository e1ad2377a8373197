"""The pipeline against plain versions of its stages, chained."""

import re
from collections import defaultdict

import pytest

import brute
import corpus_pipeline as cp
from caselabel.llm import language_id
from caselabel.llm.samples import fold_of
from test_decontaminate import brute as brute_contaminated
from test_line_dedup import key
from test_mixing import brute as brute_mix

SMALL = "/root/testdata/sf0.001"


def plain_lines(rows):
    holders = defaultdict(set)
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                holders[k].add(i)
    return [(i, text if text is None else "\n".join(x for x in text.split("\n") if len(holders[key(x)]) < 3 or i == max(holders[key(x)]))) for i, text in rows]


@pytest.fixture(scope="module")
def steps(spark):
    """Rows of each stage, by the stages as the driver runs them."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(stage(spark, out[-1], SMALL).cache())
    return out


def test_columns_stay_until_the_last_stage(steps):
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    assert [name for name, _ in cp.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontaminate", "mix"]


def test_run_against_plain_stages(spark, steps):
    source = {r.doc_id: r.source for r in steps[0].collect()}
    rows = [(r.doc_id, r.text) for r in steps[0].collect()]
    model = language_id.fit(steps[0].where(fold_of(steps[0].doc_id, 3) != 1))
    _, scores, known = model.judge([t or "" for _, t in rows])
    rows = [r for r, k, s in zip(rows, known, scores, strict=True) if k and s >= cp.LEAST_LANGUAGE_SCORE]
    assert sorted(rows) == sorted((r.doc_id, r.text) for r in steps[1].collect())
    rows = plain_lines(rows)
    assert sorted(rows) == sorted((r.doc_id, r.text) for r in steps[2].collect())
    comps = brute.jaccard_components(rows, 5, 80, 100)
    rows = [(i, t) for i, t in rows if comps[i][1] == i]
    assert sorted(rows) == sorted((r.doc_id, r.text) for r in steps[3].collect())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    # The plain tiling is slow, so it looks at documents with a shared run of five words only; others can't match.
    words = lambda t: re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", t.lower())
    seeds = {tuple(w[i : i + 5]) for _, t in items for w in [words(t)] for i in range(len(w) - 4)}
    near = [(i, t) for i, t in rows if any(tuple(w[j : j + 5]) in seeds for w in [words(t)] for j in range(len(w) - 4))]
    bad = {r[0] for r in brute_contaminated(near, items)}
    rows = [(i, t) for i, t in rows if i not in bad]
    assert sorted(rows) == sorted((r.doc_id, r.text) for r in steps[4].collect())
    want = brute_mix([(i, t, source[i]) for i, t in rows])
    got = sorted((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in steps[5].collect())
    assert sorted(got, key=str) == want
    assert sorted(map(tuple, cp.run(spark, SMALL).collect())) == sorted(map(tuple, steps[5].collect()))


def test_stages_on_an_empty_table_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int"
    odd = [(1, None, "en", None, None, 1), (2, "", None, "a", 0, 1), (3, "x", "en", "a", 1, 1), (3, "x", "en", "a", 1, 1), (None, "the word", None, "a", 8, 1)]
    for data in ([], odd):
        docs = spark.createDataFrame(data, schema)
        for i, (_, stage) in enumerate(cp.STAGES):
            out = stage(spark, docs, SMALL)
            if i < len(cp.STAGES) - 1:
                assert out.columns == docs.columns
            out.collect()
    # Without labels there is no language to know, so what has one keeps the rest small.
    docs = spark.createDataFrame(odd, schema)
    assert {r.doc_id for r in cp.drop_repeated_lines(spark, docs, SMALL).collect()} == {1, 2, 3, None}
    assert sorted((r.doc_id for r in cp.keep_one_of_near_copies(spark, docs, SMALL).collect()), key=str) == [1, 2, 3, None]
