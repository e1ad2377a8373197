import hashlib
import random
import re
import string

import numpy as np
from pyspark.sql import functions as F

from caselabel.llm import secret_scan as ss

BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile("[0-9a-f]+"), 0, 16),
]


def brute_base(text):
    found = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        found += [(m.start(), order, m.end(), kind) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return [(k, a, b) for a, _, b, k in sorted(found)]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def check(spark, rows):
    got = ss.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        base = brute_base(text[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in base) for k, *_ in BASE)
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if not s.startswith("random")] == [f"{k}:{a}:{b}" for k, a, b in base]
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), ["assign", "access", "hex", "random"].index(s.split(":")[0])))
    return got


def test_base_spans(spark):
    rnd = random.Random(2)
    bits = ["password=", "PassWD : '", 'secret": "', "token=", "api_key=", "APIKEY = ", "abcdefghijkl", "AKIA", "ABCD1234EFGH5678", "deadbeef", "0123456789abcdef",
            " ", "\n", "é", "😀", "x", "=", ":", "'", "-", "password", "token: short ", "AKIAAKIA", "/+._="]
    rows = [(i, "".join(rnd.choices(bits, k=rnd.randrange(0, 25)))) for i in range(500)]
    rows += [(1001, None), (1002, ""), (1003, "password=token: abcdefghijklmnop"), (1004, "password=token=abcdefghijklmnop"), (1005, ("ab 😀 0123456789abcdef0 " * 4000))]
    check(spark, rows)


def test_repeated_rows_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "token=abcdefghijklmn", 1, "a")] * 2 + [(None, "x", 1, "a")], "doc_id long, text string, row int, runs string")
    got = sorted(map(tuple, ss.scan(df).collect()), key=str)
    assert len(got) == 3 and got[0] == got[1] and got[0][5] == "assign:0:20"
    assert ss.scan(df.limit(0)).collect() == []


def corpus(rnd):
    syllables = ["thin", "ter", "ness", "under", "stand", "ation", "over", "ing", "counter", "pro", "duc", "tive", "less", "ful"]
    rows, planted = [], {}
    for i in range(400):
        words = ["".join(rnd.choices(syllables, k=rnd.randrange(1, 9))) for _ in range(30)]
        if i % 20 == 0:
            secret = "".join(rnd.choices(string.ascii_letters + string.digits, k=rnd.choice([40, 48, 64])))
            words.insert(10, secret)
            planted[i] = secret
        rows.append((i, " ".join(words)))
    return rows, planted


def test_long_random_strings_are_added_and_words_are_not(spark):
    rows, planted = corpus(random.Random(6))
    got = check(spark, rows)
    flagged = {r.doc_id: [rows[r.doc_id][1][int(a) : int(b)] for k, a, b in (s.split(":") for s in r.spans.split(",") if s) if k == "random"] for r in got}
    right = sum(flagged[i] == [s] for i, s in planted.items())
    assert right >= 0.8 * len(planted)
    assert all(not f for i, f in flagged.items() if i not in planted)


def plain_battery(token):
    bare = token.rstrip("=")
    alphabet = next(a for _, p, a in ss.ENCODINGS if re.match(p, bare))
    n, size = len(bare), len(alphabet)
    counts = np.array([bare.count(c) for c in alphabet])
    chi = (counts**2).sum() * size / n - n
    spread = 2 / (9 * (size - 1))
    z_even = ((max(chi, 0) / (size - 1)) ** (1 / 3) - (1 - spread)) / np.sqrt(spread)
    index = np.array([alphabet.index(c) + 1.0 for c in bare])
    high = index > size // 2
    ones, zeros = high.sum(), n - high.sum()
    expected = 2 * ones * zeros / n
    var = expected * (expected - 1) / (n - 1)
    z_runs = ((high[1:] != high[:-1]).sum() - expected) / np.sqrt(var) if var > 0 else 99.0
    d = index - index.mean()
    z_serial = ((d[1:] * d[:-1]).sum() / (d * d).sum() + 1 / n) * np.sqrt(n) if (d * d).sum() > 0 else 99.0
    return z_even, z_runs, z_serial


def test_battery_against_plain_version(spark):
    rnd = random.Random(8)
    alphabets = [a for *_, a in ss.ENCODINGS]
    tokens = ["".join(rnd.choices(rnd.choice(alphabets), k=rnd.randrange(20, 90))) for _ in range(120)] + ["a" * 30, "ab" * 15, "0" * 25 + "=="]
    got = ss.battery(spark.createDataFrame([(t,) for t in tokens], "token string")).collect()
    assert len(got) == len(tokens)
    for r in got:
        assert np.allclose((r.z_even, r.z_runs, r.z_serial), plain_battery(r.token), rtol=1e-6, atol=1e-6)


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "token=abcdefghijklmn")], "doc_id long, text string")
    plan = ss.scan(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert F.col  # the module is expressions only


DIGITS, LOWER, UPPER = string.digits, string.ascii_lowercase, string.ascii_uppercase
#: Encoding, alphabet, length, what stands around it.
RARE = [
    ("upper hex", DIGITS + "ABCDEF", 64, "{}"),
    ("upper hex", DIGITS + "ABCDEF", 40, "id:{}"),
    ("base32", UPPER + "234567", 40, "{}===="),
    ("base36", LOWER + DIGITS, 40, "{}"),
    ("base62", UPPER + LOWER + DIGITS, 40, "{}"),
    ("base64", UPPER + LOWER + DIGITS + "+/", 40, "AWS_SECRET_ACCESS_KEY={}"),
    ("base64", UPPER + LOWER + DIGITS + "+/", 43, "KEY={}="),
    ("base64", UPPER + LOWER + DIGITS + "+/", 64, "{}_tail"),
    ("base64url", UPPER + LOWER + DIGITS + "-_", 43, "KEY={}"),
]


def test_each_encoding_is_found_when_rare(spark):
    rnd = random.Random(5)
    syllables = ["thin", "ter", "ness", "under", "stand", "ation", "over", "ing", "counter", "pro", "duc", "tive", "less", "ful"]

    def ordinary():
        word = lambda: "".join(rnd.choices(syllables, k=rnd.randrange(1, 4)))
        kind = rnd.randrange(12)
        if kind < 6:
            return "".join(rnd.choices(syllables, k=rnd.randrange(6, 12)))
        if kind == 6:
            return "_".join(word() for _ in range(5)).upper() + "=" + word()
        if kind == 7:
            return "/".join(word() for _ in range(5)) + str(rnd.randrange(2000))
        if kind == 8:
            return "".join(word().capitalize() for _ in range(5))
        if kind == 9:
            return "-".join(word() for _ in range(5)) + "-" + str(rnd.randrange(1990, 2030))
        if kind == 10:
            return "".join(rnd.choices(DIGITS, k=rnd.randrange(20, 40)))
        return "".join(word() for _ in range(8)).upper()

    rows = [(i, " ".join(ordinary() for _ in range(200))) for i in range(450)]  # 90,000 candidates, 1 in 10,000 planted
    planted = {}
    for i, (_, alphabet, n, around) in enumerate(RARE):
        secret = "".join(rnd.choices(alphabet, k=n))
        planted[50 * i] = secret
        rows[50 * i] = (50 * i, rows[50 * i][1] + " " + around.format(secret))
    text = dict(rows)
    flagged = {}
    for r in check(spark, rows):
        for kind, a, b in (s.split(":") for s in r.spans.split(",") if s):
            if kind == "random":
                flagged.setdefault(r.doc_id, []).append(text[r.doc_id][int(a) : int(b)])
    missed = [RARE[i // 50] for i, secret in planted.items() if not any(secret.rstrip("=") in f or f.rstrip("=") in secret for f in flagged.get(i, []))]
    assert not missed
    assert sum(len(f) for f in flagged.values()) <= len(planted) + 1
