import random
import zlib
from collections import Counter

import numpy as np
import pytest

from caselabel.llm import language_id as li

SAYINGS = {
    "aa": "mokuta sirano batele norima kasuto wenari",
    "bb": "schlurz grempf knarbst wolmtz drauscht pfelk",
    "cc": "ëlliè uîne ôvéa çaûre ïliéo èauté",
}


def rows(n=240, seed=2):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        lang = rnd.choice(list(SAYINGS))
        syllables = SAYINGS[lang].split()
        words = [rnd.choice(syllables)[: rnd.randrange(2, 7)] + rnd.choice(syllables)[-3:] for _ in range(rnd.randrange(4, 60))]
        out.append((i, " ".join(words), lang))
    return out


def test_held_out_accuracy(spark):
    data = rows()
    truth = {i: lang for i, _, lang in data}
    got = li.identify(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(data)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def test_held_out_labels_are_not_seen(spark):
    data = rows(90)
    other = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in data]
    a, b = ({(r.doc_id, r.lang_pred, r.score) for r in li.identify(spark.createDataFrame(x, "doc_id long, text string, lang string")).collect()} for x in (data, other))
    assert a == b


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = li.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97


def plain_presence(text):
    """Buckets of the n-grams, one by one."""
    found, text = set(), text.lower()
    for p in range(1, li.SPECTRUM + 1):
        for i in range(len(text) - p + 1):
            if "\n" in text[i : i + p]:
                continue
            code = 0
            for j in range(p):
                code = (code * 0x01000193 + ord(text[i + j]) * int(li._FACTORS[j])) & 0xFFFFFFFF
            mixed = ((code ^ (code >> 15)) * 0x2C1B3C6D) & 0xFFFFFFFF
            found.add(mixed >> (32 - li.BUCKET_BITS))
    return found


def test_presence_and_ridge_against_plain_versions():
    texts = [t for _, t, _ in rows(60)] + ["", "a", "1 2", "é\nb"]
    grid, with_letter = li.presence(texts)
    for t, row in zip(texts, grid, strict=True):
        assert set(np.flatnonzero(row)) == plain_presence(t)
    assert with_letter.tolist() == [any(c.isalpha() for c in t) for t in texts]
    labels = [lang for *_, lang in rows(60)]
    model = li.Model.fit(grid[:60], labels, landmarks=5)
    sets = [plain_presence(t) for t in texts]
    kernel = lambda a, b: len(a & b) / np.sqrt(max(len(a), 1) * max(len(b), 1))
    names = sorted(set(labels))
    marks = [i for c in names for i in [j for j in range(60) if labels[j] == c][:5]]
    k_nm = np.array([[kernel(sets[i], sets[j]) for j in marks] for i in range(60)])
    weight = np.array([1 / labels.count(x) for x in labels])
    y = np.array([[1.0 if x == c else -1.0 for c in names] for x in labels])
    left = (k_nm.T * weight) @ k_nm + li.RIDGE * k_nm[marks] + 1e-9 * np.eye(len(marks))
    alpha = np.linalg.solve(left, (k_nm.T * weight) @ y)
    want = np.array([[kernel(s, sets[j]) for j in marks] for s in sets]) @ alpha
    assert np.abs(model.scores(grid) - want).max() < 0.02


def test_known_rule_against_a_plain_version():
    labelled = rows(60)
    others = ["Быстрая коричневая лиса", "xq zv kj wq", "", "12 34", "no", labelled[0][1][:12], labelled[1][1] + " Быстрая лиса прыгает"]
    texts = [t for _, t, _ in labelled] + others
    grid, with_letter = li.presence(texts)
    model = li.Model.fit(grid[:60], [lang for *_, lang in labelled], landmarks=5)
    names, _, known = model.judge(texts)
    sets = [plain_presence(t) for t in texts]
    bars, seen = {}, {}
    for c in sorted({lang for *_, lang in labelled}):
        own = [sets[i] for i in range(60) if labelled[i][2] == c]
        holders = Counter(x for s in own for x in s)
        seen[c] = set(holders)
        bars[c] = float(np.quantile([sum(holders[x] > 1 for x in s) / max(len(s), 1) for s in own], li.LOST))
    for text, name, mine, s, letter in zip(texts, names, known, sets, with_letter, strict=True):
        if not letter:
            assert name == "und" and not mine
            continue
        bar, size = bars[name], max(len(s), 1)
        want = len(s & seen[name]) / size >= bar - li.SLACK * np.sqrt(6 * bar * (1 - bar) / size)
        assert mine == want, text
    assert known[:60].all() and not known[60] and not known[61]


def test_every_text_with_a_letter_has_a_learned_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    strange = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(["Быстрая лиса", "これは日本語", "xqzvkj", "ß"])], "doc_id long, text string")
    got = li.identify(docs.unionByName(strange, allowMissingColumns=True)).join(docs.select("doc_id", "text"), "doc_id", "left").collect()
    learned = {r.lang for r in docs.select("lang").distinct().collect()}
    assert {r.lang_pred for r in got if r.doc_id >= 10**9} <= learned
    assert all((r.lang_pred == "und") != any(c.isalpha() for c in r.text or "") for r in got if r.doc_id < 10**9)


def test_odd_rows(spark):
    data = [(i, t, lang, 1) for i, t, lang in rows(120)]
    data += [(900, None, "aa", 1), (901, "", None, 1), (902, "12 + 34 !!", "aa", 1), (903, "mokuta " * 30_000, None, 1), (904, "norima", "aa", 1), (904, "norima", "aa", 1), (None, "mokuta sirano", "aa", 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in li.identify(df).collect()}
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0
    assert got[903].lang_pred == "aa" and None in got
    assert li.identify(df).count() == len(data)
    assert li.identify(df.limit(0)).collect() == []
    none = li.identify(df.selectExpr("doc_id", "text", "CAST(NULL AS STRING) lang")).select("lang_pred").distinct().collect()
    assert [r[0] for r in none] == ["und"]


@pytest.mark.parametrize("least, gone", [(0.0, {900, 902}), (1.01, "all")])
def test_rejected_rows_go(spark, least, gone):
    data = [(i, t, lang, 1) for i, t, lang in rows(60)] + [(900, None, "aa", 1), (902, "12 + 34 !!", "aa", 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, score int")
    out = li.keep_known(df, li.fit(df), least)
    assert out.columns == df.columns
    want = [] if gone == "all" else [r for r in data if r[0] not in gone]
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_texts_in_no_known_language_go_at_the_pipelines_bar(spark):
    import corpus_pipeline as cp

    rnd = random.Random(3)
    junk = lambda letters, n: " ".join("".join(rnd.choices(letters, k=rnd.randrange(4, 10))) for _ in range(n))
    strange = [
        "Быстрая коричневая лиса прыгает через ленивую собаку и уходит в лес за грибами.",
        "這是一個測試文件，內容完全是中文，沒有其他語言的文字。",
        "Η γρήγορη αλεπού πηδά πάνω από το τεμπέλικο σκυλί.",
        "これは日本語の文章です。とても長い文を書いています。",
        *(junk("bcdfghjklmnpqrstvwxz", n) for n in (6, 40, 400)),
        *(junk("abcdefghijklmnopqrstuvwxyz", n) for n in (20, 400)),
    ]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    clean = [r.text for r in docs.where("doc_id IS NOT NULL AND length(text) > 200").orderBy("doc_id").limit(100).collect()]
    short = [" ".join(t.split()[:n]) for t, n in zip(clean, [3, 5, 8, 12] * 25, strict=True)]
    short = [t for t in short if any(c.isalpha() for c in t)]
    planted = [(10**9 + i, t) for i, t in enumerate(strange + short)]
    whole = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = spark.createDataFrame(planted, "doc_id long, text string")
    kept = cp.keep_known_languages(spark, whole.unionByName(rows, allowMissingColumns=True), "").select("doc_id").collect()
    kept = {r.doc_id for r in kept}
    assert not kept & {i for i, _ in planted[: len(strange)]}
    lost = [t for i, t in planted[len(strange) :] if i not in kept]
    assert not lost
    assert len(kept & {r.doc_id for r in docs.collect()}) >= 0.995 * docs.count()


def test_250_small_languages(spark):
    rnd = random.Random(11)
    syllables = [["".join(rnd.choices("abcdefghijklmnopqrstuvwxyzäöüñçéèø", k=rnd.randrange(2, 5))) for _ in range(14)] for _ in range(250)]
    say = lambda s: " ".join("".join(rnd.choices(s, k=rnd.randrange(1, 4))) for _ in range(rnd.randrange(20, 60)))
    data = [(i, say(syllables[i % 250]), f"l{i % 250:03}") for i in range(250 * 12)]
    data += [(10_000 + i, say(syllables[i % 200]), f"l{i % 200:03}") for i in range(1000)]  # the last 50 are rarer
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = li.identify(df).where("held_out").join(df.select("doc_id", "lang"), "doc_id").collect()
    assert {r.lang_pred for r in got} >= {f"l{i:03}" for i in range(200, 250)} & {r.lang for r in got}
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    model = li.fit(df, max_sample=100)  # fewer than languages: one row of each
    assert len(model.languages) == 250
