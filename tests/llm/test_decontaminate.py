import random
import re

import pyarrow as pa
import pytest

from caselabel.llm import decontaminate as dc
from caselabel.llm import words as wd


def tokens(text):
    return re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_tiles(text, item, k):
    """Try all pairs of places, again and again."""
    text, item, out = list(text), list(item), []
    while True:
        best = (k - 1, 0, 0)
        for j in range(len(item)):
            for i in range(len(text)):
                n = 0
                while i + n < len(text) and j + n < len(item) and text[i + n] is not None and text[i + n] == item[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < k:
            return out
        out.append((i, j, n))
        text[i : i + n] = [None] * n
        item[j : j + n] = [None] * n


def brute(docs, items, k=5, coverage=0.5):
    out = []
    for d, text in docs:
        for b, item in items:
            words = tokens(item)
            if len(words) < k:
                continue
            tiles = brute_tiles(tokens(text), words, k)
            matched = sum(t[2] for t in tiles)
            if matched >= coverage * len(words):
                out.append((d, b, len(tiles), matched, len(words)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    found = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), **options)
    return sorted(((r.doc_id, r.item_id, r.n_tiles, r.matched_words, r.item_words) for r in found.collect()), key=str)


def corpus(seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "naïve", "x1"]
    say = lambda n: rnd.choices(vocabulary, k=n)
    items = [(i, say(rnd.randrange(3, 40))) for i in range(12)]
    docs = []
    for d in range(60):
        words = say(rnd.randrange(0, 50))
        if d % 2:
            passage = list(rnd.choice(items)[1])
            kind = d % 10
            if kind == 3:  # reordered halves
                passage = passage[len(passage) // 2 :] + say(3) + passage[: len(passage) // 2]
            elif kind == 5:
                passage = passage[: len(passage) // 2 + 1]
            elif kind == 7 and passage:
                passage[rnd.randrange(len(passage))] = "changed"
            words = words[:20] + passage + words[20:]
        docs.append((d, rnd.choice([" ", ", ", "\n"]).join(w.upper() if w.isascii() and d % 3 else w for w in words)))
    return docs, [(i, " ".join(w)) for i, w in items]


@pytest.mark.parametrize("options", [{}, {"coverage": 0.9}, {"block_bytes": 300}])
def test_against_brute_force(spark, options):
    docs, items = corpus()
    want = brute(docs, items, coverage=options.get("coverage", 0.5))
    assert run(spark, docs, items, **options) == want
    assert len(want) > 10


def test_tiling_of_random_sequences():
    rnd = random.Random(4)
    for _ in range(150):
        text, item = ([rnd.randrange(4) for _ in range(rnd.randrange(0, 40))] for _ in range(2))
        hashed = [wd.words(*wd.buffers(pa.array([" ".join(f"t{x}" for x in s)]))).hash for s in (text, item)]
        got = dc.tile(*hashed, 3)
        want = brute_tiles(text, item, 3)
        assert [t[2] for t in got][:1] == [t[2] for t in want][:1]
        used = set()
        for i, j, n in got:
            assert text[i : i + n] == item[j : j + n] and n >= 3
            places = {("t", x) for x in range(i, i + n)} | {("i", x) for x in range(j, j + n)}
            assert not places & used
            used |= places


def test_odd_rows(spark):
    passage = "one two three four five six seven"
    docs = [(1, None), (2, ""), (3, passage), (3, passage), (None, f"so {passage} it is"), (5, "one two three"), (6, "a " * 30_000 + passage)]
    items = [(1, None), (2, ""), (3, passage), (4, "one two"), (None, passage)]
    want = [(d, b, 1, 7, 7) for d in (3, 3, None, 6) for b in (3, None)]
    assert run(spark, docs, items) == sorted(want, key=str)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []


def test_repetitive_text(spark):
    docs = [(1, "the " * 20_000), (2, "the " * 3)]
    assert run(spark, docs, [(1, "the " * 30)]) == [(1, 1, 1, 30, 30)]


def test_clean_rows_keep_all_columns(spark):
    docs, items = corpus()
    df = spark.createDataFrame([(d, t, "x", d) for d, t in docs], "doc_id long, text string, item_id string, coverage long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    bad = {r[0] for r in brute(docs, items)}
    for options in ({}, {"block_bytes": 300}):
        got = dc.decontaminate(df, bench, **options)
        assert got.columns == df.columns
        assert sorted(map(tuple, got.collect())) == sorted((d, t, "x", d) for d, t in docs if d not in bad)
    assert dc.decontaminate(df, bench.limit(0)).count() == len(docs)


def test_short_items_and_scripts_without_blanks(spark):
    items = [(1, "Capital of Peru?"), (2, "水的沸點是多少度？請說明理由。"), (3, "地球"), (4, "น้ำเดือดที่อุณหภูมิเท่าใด"), (5, "He said “never, ever again” — twice\u00a0today"), (6, "?!")]
    docs = [
        (10, "Capital of Peru?"),
        (11, "Some line\n capital of PERU\nLima"),
        (12, "The capital of Peru is Lima"),
        (20, "問題：水的沸點是多少度？請說明理由。答案是一百度。"),
        (21, "今天天氣很好，我們去公園散步。"),
        (30, "地球"),
        (31, "地球是圓的"),
        (40, "คำถาม น้ำเดือดที่อุณหภูมิเท่าใด"),
        (50, 'He said "never, ever again" - twice today'),
        (51, "He said «never, ever again» – twice\u2009today"),
        (60, "?!"),
    ]
    got = {(d, b): (n, m, w) for d, b, n, m, w in run(spark, docs, items)}
    assert set(got) == {(10, 1), (11, 1), (20, 2), (30, 3), (40, 4), (50, 5), (51, 5)}
    assert got[10, 1] == got[11, 1] == (1, 3, 3) and got[30, 3] == (1, 2, 2) and got[20, 2] == (1, 13, 13)
    assert got[50, 5] == got[51, 5] == (1, 7, 7)
    assert {d for d, *_ in run(spark, docs, items, block_bytes=10)} == {d for d, _ in got}


def test_words_against_a_plain_version():
    rnd = random.Random(9)
    bits = [*"aZ0é水ーกำ", " ", "\u00a0", "“", "…", "\n", "😀", "́", "𠀀", "한국", "ß", "-", "。"]
    texts = ["".join(rnd.choices(bits, k=rnd.randrange(0, 30))) for _ in range(300)]
    got = dc._words(*wd.buffers(pa.array(texts, pa.string())))
    data = "".join(texts).encode()
    for i, t in enumerate(texts):
        want = re.findall(r"[水ーกำ𠀀]|[aZ0é한국ß́]+", t)
        spans = range(got.first[i], got.first[i + 1])
        assert [data[got.start[s] : got.end[s]].decode() for s in spans] == want
