import hashlib
import random
import re
from collections import defaultdict

import pytest

from caselabel.llm import line_dedup as ld

BLANK = " \t\n\x0b\f\r"


def key(line):
    return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(BLANK))


def brute(rows):
    holders = defaultdict(list)
    for at, (doc, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                holders[k].append((-1 << 63 if doc is None else doc, at))
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        rank = -1 << 63 if doc is None else doc
        kept = [x for x in lines if len(holders[key(x)]) < 3 or rank == max(holders[key(x)])[0]]
        sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc, len(lines), len(lines) - len(kept), sha))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, ld.dedup_report(df, **options).collect()), key=str)


@pytest.mark.parametrize("batches", [1, 3, 8])
def test_against_brute_force(spark, batches):
    rnd = random.Random(batches)
    pool = [f"line number {i} of the pool, long enough" for i in range(60)] + ["short", "", "  \t", "x" * 20, "É" * 19, "É" * 20]
    rows = []
    for i in range(150):
        lines = [rnd.choice(pool) if rnd.random() < 0.6 else f"own line {i} {rnd.random()} goes here" for _ in range(rnd.randrange(0, 12))]
        lines = [rnd.choice([x, x.upper(), f" \t{x}\r", x]) for x in lines]
        rows.append((rnd.randrange(10**6), "\n".join(lines)))
    assert run(spark, rows, batches=batches) == brute(rows)


def test_odd_rows(spark):
    common = "This very line is in many documents"
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, common), (5, f"{common}\n{common}"), (6, f"a\n{common}\nb"), (6, f"a\n{common}\nb")]
    rows += [(None, common), (None, f"{common}\nmine")]
    rows.append((9, "\n".join(f"line {i} of a very long document" for i in range(30_000)) + f"\n{common}"))
    assert run(spark, rows) == brute(rows)


def test_hot_line(spark):
    common = "One license line that everybody has"
    rows = [(i, f"{common}\nown line {i} with enough characters\n" + (common if i % 2 else "")) for i in range(3000)]
    assert run(spark, rows) == brute(rows)


def test_two_documents_keep_their_lines(spark):
    rows = [(1, "a line held by two documents only"), (2, "a line held by two documents only")]
    assert [r[2] for r in run(spark, rows)] == [0, 0]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_text_is_cut_and_other_columns_stay(spark):
    common = "One license line that everybody has"
    rows = [(i, f"{common}\nrest {i}", "k", 7, 99) for i in range(3)] + [(9, None, "z", 8, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, _row int, n_chars long")
    got = {r.doc_id: r for r in ld.dedup_lines(df).collect()}
    assert ld.dedup_lines(df).columns == df.columns
    assert got[0].text == "rest 0" and got[0].n_chars == 6 and got[0].row == "k" and got[0]["_row"] == 7
    assert got[2].text == f"{common}\nrest 2" and got[2].n_chars == 99
    assert got[9].text is None


def test_runs_are_compacted_and_hold_each_key_once(spark):
    runs = ld.LineRuns(fan=2)
    for b in range(7):
        rows = [(k, k, 100 - b, 1) for k in range(b * 5, b * 5 + 20)]
        runs.add(spark.createDataFrame(rows, "h1 long, h2 long, owner long, n_docs long"))
    held = [r.h1 for run in runs.runs() for r in run.collect()]
    assert sorted(held) == list(range(50))
    assert len(runs.runs()) < 7 and len(runs.levels) > 1
    counts = {r.h1: (r.owner, r.n_docs) for r in runs.repeated(3).collect()}
    for k in range(50):
        seen = [b for b in range(7) if b * 5 <= k < b * 5 + 20]
        assert counts.get(k) == ((100 - seen[0], len(seen)) if len(seen) >= 3 else None)
