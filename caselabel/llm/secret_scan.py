"""Secret scan: fixed patterns, and a battery of randomness tests for everything else.

**Base.**  Three patterns with a least length each; see ``KINDS``.

**Battery.**  Candidates are runs of at least ``SHORTEST`` characters of the
base64 or of the base64url alphabet that no base span touches; an inner ``=``
and a change of alphabet end a run, so the value of ``KEY=value`` is one.  The
characters in a run tell its encoding, and with it the alphabet.  Three tests
look at it:

* chi-squared uniformity over the alphabet,
* the runs test: changes between the lower and the upper half of the alphabet,
* serial correlation of neighbouring characters.

A run that one of them finds far from random is ordinary.  For the others the
question is whether ordinary writing could look like that, asked in two ways:

* The sum of squared character counts, on which chi-squared rests, has a known
  mean and variance for ordinary writing of the same length, given the character
  frequencies of the corpus's own long words.
* The ordinary runs of the same encoding give chances for a character after a
  digit, capital, small letter or sign; few such runs lean on those of all
  encodings.  The chance of a run that is drawn evenly from its alphabet, over
  that of ordinary writing, reaches ``1 / p`` with probability ``p`` at most.
  This finds what mixes kinds of characters as ordinary runs don't, such as hex
  in capitals and base32, although its counts are no more even than words'.

The p-value is twice the smaller one.  P-values are cut by false-discovery
control (Benjamini-Hochberg) within classes of length, from a histogram of all
candidates of all documents.

Everything is DataFrame expressions; texts never leave their rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caselabel.llm.tables import written

#: Kind, pattern, group with a least length, and that length.
KINDS = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),  # the same runs as [0-9a-f]+ of 16 or more, without the many short ones
]
RANDOM = "random"
SHORTEST = 20
_SIGNS = "+/-_"
#: A run that does not go on in the other alphabet, or one of base64url, or what is left of base64; then its padding.
CANDIDATE = (
    rf"(?:[A-Za-z0-9+/]{{{SHORTEST},}}+(?![_-])|[A-Za-z0-9_-]{{{SHORTEST},}}+|[A-Za-z0-9+/]{{{SHORTEST},}}+)"
    r"(?:={1,6}(?![A-Za-z0-9+/_=-]))?"
)
#: Encodings by the characters that occur, the first that fits; then their alphabets.
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = [
    ("decimal", "^[0-9]+$", _DIGITS),
    ("hex", "^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("upper hex", "^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("lower", "^[a-z]+$", _LOWER),
    ("upper", "^[A-Z]+$", _UPPER),
    ("base32", "^[A-Z2-7]+$", _UPPER + "234567"),
    ("base36", "^[a-z0-9]+$", _DIGITS + _LOWER),
    ("letters", "^[A-Za-z]+$", _UPPER + _LOWER),
    ("base62", "^[A-Za-z0-9]+$", _DIGITS + _UPPER + _LOWER),
    ("base64url", "^[A-Za-z0-9_-]+$", _UPPER + _LOWER + _DIGITS + "-_"),
    ("base64", "^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
]
#: Characters of all ordinary runs that count beside those of an encoding's own.
LEANING = 100.0
#: Ordinary words, whatever the battery says.
WORD = "^[A-Z]?[a-z]+$"
#: Standard deviations beyond which a test rejects randomness.
REJECT = 3.3
DISCOVERIES = 0.01
LENGTHS = [24, 32, 48, 80]
#: Histogram of p-values: steps per factor of ten, and most steps.
STEPS, MOST_STEPS = 20, 800


def found_spans(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """``array<struct<start, end, value>>`` of the leftmost non-overlapping matches, in code points.

    Splitting at the pattern gives what stands between the matches; running
    lengths of both give the places.  They are summed in blocks of about the
    square root of the number, so texts with very many matches stay affordable.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    between = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def bind(value: Column, body) -> Column:
        """``body`` on a value that is computed once."""
        return F.element_at(F.transform(F.array(value), body), 1)

    def total(lengths: Column) -> Column:
        return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)

    def placed(x: Column) -> Column:
        gap, size = x["gap"], x["size"]
        step = F.transform(size, lambda n, i: n + F.get(gap, i))
        block = F.ceil(F.sqrt(F.size(size))).cast("int")

        def with_step(s: Column) -> Column:
            count = F.ceil(F.size(s["step"]) / s["block"]).cast("int")
            sums = F.transform(F.sequence(F.lit(0), count - 1), lambda b: total(F.slice(s["step"], b * s["block"] + 1, s["block"])))

            def with_sums(q: Column) -> Column:
                before = F.transform(q, lambda _, b: total(F.slice(q, F.lit(1), b)))

                def with_before(z: Column) -> Column:
                    def span(n: Column, i: Column) -> Column:
                        b = F.floor(i / s["block"]).cast("int")
                        start = F.get(z, b) + total(F.slice(s["step"], b * s["block"] + 1, i - b * s["block"])) + F.get(gap, i)
                        return F.struct(
                            start.alias("start"),
                            (start + n).alias("end"),
                            F.get(x["value"], i).alias("value"),
                            F.length(F.get(x["inner"], i)).alias("n"),
                        )

                    return F.transform(size, span)

                return bind(before, with_before)

            return bind(sums, with_sums)

        return bind(F.struct(step.alias("step"), block.alias("block")), with_step)

    parts = F.struct(
        F.transform(between, F.length).alias("gap"),
        F.transform(whole, F.length).alias("size"),
        whole.alias("value"),
        inner.alias("inner"),
    )
    spans = F.transform(
        F.filter(bind(parts, placed), lambda s: s["n"] >= least),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")),
    )
    return F.when(F.size(whole) == 0, none).otherwise(spans)


def _count(token: Column, char: str) -> Column:
    return F.length(token) - F.length(F.replace(token, F.lit(char), F.lit("")))


def _per_encoding(body) -> Column:
    """``body(alphabet)`` of the token's encoding."""
    out = None
    for name, _, alphabet in ENCODINGS:
        value = body(alphabet)
        out = F.when(F.col("encoding") == name, value) if out is None else out.when(F.col("encoding") == name, value)
    return out


def _upper_tail(z: Column) -> Column:
    """Normal upper tail, for z of 0 and more a bound that is tight for large z."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery(tokens: DataFrame) -> DataFrame:
    """``tokens`` (with ``token``) with ``encoding, n, squares`` and the tests' deviations ``z_even, z_runs, z_serial``.

    Padding at the end belongs to no alphabet and is left out.
    """
    bare = F.rtrim(F.col("token"), F.lit("="))
    encoding = F.coalesce(*(F.when(F.col("bare").rlike(pattern), name) for name, pattern, _ in ENCODINGS))
    df = tokens.withColumn("bare", bare).withColumn("encoding", encoding)
    df = df.where("encoding IS NOT NULL").withColumn("n", F.length("bare").cast("double"))

    def squares(alphabet: str) -> Column:
        return F.aggregate(
            F.array(*map(F.lit, alphabet)),
            F.lit(0.0),
            lambda a, c: a + F.pow(F.length("bare") - F.length(F.replace(F.col("bare"), c, F.lit(""))), F.lit(2)),
        )

    def halves(alphabet: str) -> Column:
        half = len(alphabet) // 2
        return F.translate("bare", alphabet, "0" * half + "1" * (len(alphabet) - half))

    def indexes(alphabet: str) -> Column:
        return F.transform(F.split("bare", ""), lambda c: F.instr(F.lit(alphabet), c).cast("double"))

    df = df.withColumns(
        {
            "squares": _per_encoding(squares),
            "bits": _per_encoding(halves),
            "codes": _per_encoding(indexes),
            "size": _per_encoding(lambda a: F.lit(float(len(a)))),
        }
    )
    free = F.col("size") - 1
    chi = F.col("squares") * F.col("size") / F.col("n") - F.col("n")
    spread = 2 / (9 * free)
    z_even = (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)
    ones = F.length(F.replace("bits", F.lit("0"), F.lit(""))).cast("double")
    zeros = F.col("n") - ones
    changes = sum((F.length("bits") - F.length(F.replace("bits", F.lit(two), F.lit("")))) / 2 for two in ("01", "10"))
    expected = 2 * ones * zeros / F.col("n")
    deviation = F.sqrt(expected * (expected - 1) / (F.col("n") - 1))
    # Changes are one less than runs; so is their mean.  A run on one side of the alphabet only is far from random.
    z_runs = F.when(deviation > 0, (changes - expected) / deviation).otherwise(99.0)
    mean = F.aggregate("codes", F.lit(0.0), lambda a, x: a + x) / F.col("n")

    def products(mu: Column) -> Column:
        return F.aggregate(
            "codes",
            F.struct(F.lit(0.0).alias("same"), F.lit(0.0).alias("next"), F.lit(None).cast("double").alias("last")),
            lambda a, x: F.struct(
                (a["same"] + (x - mu) * (x - mu)).alias("same"),
                (a["next"] + F.coalesce((x - mu) * a["last"], F.lit(0.0))).alias("next"),
                (x - mu).alias("last"),
            ),
        )

    df = df.withColumn("mu", mean).withColumn("sums", products(F.col("mu")))
    serial = F.col("sums.next") / F.col("sums.same")
    z_serial = F.when(F.col("sums.same") > 0, (serial + 1 / F.col("n")) * F.sqrt("n")).otherwise(99.0)
    return df.withColumns({"z_even": z_even, "z_runs": z_runs, "z_serial": z_serial}).drop("bare", "bits", "codes", "mu", "sums", "size")


def ordinary_frequencies(tokens: DataFrame) -> tuple[float, float]:
    """Sums of squares and cubes of the character frequencies of candidates made of letters only.

    One row of 52 sums comes to the driver.  A letter more of each lower-case
    kind keeps corpora without such candidates defined.
    """
    letters = _UPPER + _LOWER
    words = tokens.where(F.col("token").rlike(WORD))
    row = words.agg(*(F.sum(_count(F.col("token"), c)).alias(f"c{i}") for i, c in enumerate(letters))).first()
    counts = [float(row[i] or 0) + (c in _LOWER) for i, c in enumerate(letters)]
    total = sum(counts)
    return sum((c / total) ** 2 for c in counts), sum((c / total) ** 3 for c in counts)


def _random_looking() -> Column:
    return (F.col("z_even") <= REJECT) & (F.abs("z_runs") <= REJECT) & (F.abs("z_serial") <= REJECT)


def _kind(code: Column) -> Column:
    """1 to 4 for the ASCII codes of digits, capitals, small letters and signs."""
    return F.when(code.between(48, 57), 1).when(code.between(65, 90), 2).when(code.between(97, 122), 3).otherwise(4)


def _bare_codes() -> Column:
    return F.transform(F.split(F.rtrim(F.col("token"), F.lit("=")), ""), lambda c: F.ascii(c))


def evenness_ratios(tested: DataFrame) -> dict[str, list[float]]:
    """By encoding, log10 of a character's even chance over its chance in ordinary runs, at ``128 x kind before + code``.

    The counts of at most ``encodings x 5 x 64`` pairs come to the driver.  The
    kind before a first character is 0.
    """
    ordinary = tested.where(~_random_looking() | F.col("token").rlike(WORD)).select("encoding", _bare_codes().alias("codes"))
    pairs = F.transform("codes", lambda c, i: F.struct(F.when(i == 0, 0).otherwise(_kind(F.get("codes", i - 1))).alias("before"), c.alias("code")))
    rows = ordinary.select("encoding", F.inline(pairs)).groupBy("encoding", "before", "code").agg(F.count(F.lit(1)).alias("n")).collect()
    own = {(r["encoding"], r["before"], r["code"]): r["n"] for r in rows}
    codes = [ord(c) for c in _DIGITS + _UPPER + _LOWER + _SIGNS]
    out = {}
    for before in range(5):
        every = {c: 1.0 + sum(own.get((name, before, c), 0) for name, *_ in ENCODINGS) for c in codes}
        total = sum(every.values())
        for name, _, alphabet in ENCODINGS:
            known = sum(own.get((name, before, c), 0) for c in codes)
            table = out.setdefault(name, [0.0] * 640)
            for c in map(ord, alphabet):
                chance = (own.get((name, before, c), 0) + LEANING * every[c] / total) / (known + LEANING)
                table[128 * before + c] = -math.log10(len(alphabet) * chance)
    return out


def _evenness(ratios: dict[str, list[float]]) -> Column:
    """log10 of the chance of ``token`` if even, over that in ordinary runs of its encoding."""
    table = None
    for name, values in ratios.items():
        one = F.split(F.lit(" ".join(f"{v:.4f}" for v in values)), " ").cast("array<double>")
        table = F.when(F.col("encoding") == name, one) if table is None else table.when(F.col("encoding") == name, one)

    def summed(found: Column) -> Column:
        start = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))
        step = lambda a, c: F.struct(_kind(c).alias("before"), (a["sum"] + F.get(found, a["before"] * 128 + c)).alias("sum"))
        return F.aggregate(_bare_codes(), start, step, lambda a: a["sum"])

    return F.element_at(F.transform(F.array(table), summed), 1)


def unlikely_runs(tokens: DataFrame, discoveries: float = DISCOVERIES) -> DataFrame:
    """The rows of ``tokens`` (with ``token``) that pass the battery and the false-discovery control."""
    two, three = ordinary_frequencies(tokens)
    n = F.col("n")
    mean = n + n * (n - 1) * two
    variance = 2 * n * (n - 1) * (two - two**2) + 4 * n * (n - 1) * (n - 2) * max(three - two**2, 0.0)
    z = (mean - F.col("squares")) / F.sqrt(variance)
    tested = written(battery(tokens), "secret-battery")
    smallest = F.lit(10.0 ** (-MOST_STEPS / STEPS))
    mixed = F.pow(F.lit(10.0), -F.least(F.greatest(_evenness(evenness_ratios(tested)), F.lit(0.0)), F.lit(MOST_STEPS / STEPS)))
    p = F.when(_random_looking(), F.least(F.greatest(2 * F.least(_upper_tail(z), mixed), smallest), F.lit(1.0))).otherwise(1.0)
    length = sum((F.col("n") >= least).cast("int") for least in LENGTHS)
    tested = tested.withColumns({"class": length, "step": F.floor(-F.log10(p) * STEPS).cast("int")})
    # At most (classes x steps) rows, whatever the corpus; a step's upper end stands for its p-values.
    steps = tested.groupBy("class", "step").agg(F.count(F.lit(1)).alias("runs"))
    smaller = W.partitionBy("class").orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, 0)
    steps = steps.withColumns({"upto": F.sum("runs").over(smaller), "all": F.sum("runs").over(W.partitionBy("class"))})
    held = F.pow(F.lit(10.0), -F.col("step") / STEPS) <= F.col("upto") * discoveries / F.col("all")
    cut = steps.where(held).groupBy("class").agg(F.min("step").alias("cut"))
    return tested.join(F.broadcast(cut), "class").where("step >= cut").select(*tokens.columns)


def scan(docs: DataFrame, discoveries: float = DISCOVERIES) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` of every row of ``docs`` (``doc_id, text``).

    ``spans`` has all spans as ``kind:start:end`` in code points, end exclusive,
    by start and then kind, joined by commas; ``base_sha256`` is the digest of
    the same without the ``random`` spans.  Null texts count as empty and have
    no spans.  Each row stands alone, so repeated rows give repeated results.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = [found_spans(text, pattern, group, least).alias(kind) for kind, pattern, group, least in KINDS]
    runs = found_spans(text, CANDIDATE).alias("runs")
    scanned = docs.select("doc_id", *base, runs)
    names = [kind for kind, *_ in KINDS]

    def listed(name: str, order: int) -> Column:
        return F.transform(name, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("kind"), s["end"].alias("end")))

    spans = F.array_sort(F.concat(*(listed(k, i) for i, k in enumerate(names))))
    free = F.filter("runs", lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    rows = scanned.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in names), spans.alias("base"), "runs"
    ).withColumn("runs", free)
    rows = written(rows, "secret-rows")  # from here on a row's number is what the file says
    tokens = rows.select("row", F.inline("runs")).withColumnRenamed("value", "token")
    more = unlikely_runs(tokens, discoveries)
    last = len(names)
    more = more.groupBy("row").agg(F.collect_list(F.struct("start", F.lit(last).alias("kind"), "end")).alias("more"))

    def joined(items: Column) -> Column:
        kinds = F.array(*map(F.lit, [*names, RANDOM]))
        return F.concat_ws(",", F.transform(F.array_sort(items), lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])))

    full = rows.join(more, "row", "left")
    both = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more"))
    return full.select("doc_id", *(f"n_{k}" for k in names), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(both).alias("spans"))
