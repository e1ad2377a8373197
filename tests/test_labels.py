"""Truth tables of gating, states and reconciliation."""

import itertools

import pytest
from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.operators import labels as lo
from caselabel.operators import scoring as sc
from caselabel.operators import snapshots as sn


def fixed_scorer(df, label, score, only):
    """Says M with 0.9 wherever it is asked."""
    asked = F.lit(True) if only is None else only
    return df.withColumns({label: F.when(asked, "M"), score: F.when(asked, 0.9)})


def test_gate(rows):
    frame = rows("k int, words int", (0, None), (1, 0), (2, 49), (3, 50))
    out = lo.gate_and_score(frame, fixed_scorer, "words", "label", "score").orderBy("k").collect()
    assert [(r.label, r.score) for r in out] == [("N/A", 0.0)] * 3 + [("M", 0.9)]


def test_gate_new_only(rows):
    frame = rows("k string, words int", ("a", 60), ("b", 60), ("c", 10), (None, 60))
    earlier = rows("k string", ("a",), ("a",), (None,))
    out = {r.k: (r.label, r.score) for r in lo.gate_new_only(frame, earlier, fixed_scorer, "k", "words", "label", "score").collect()}
    assert out == {"a": ("N/A", 0.0), "b": ("M", 0.9), "c": ("N/A", 0.0), None: ("M", 0.9)}


def test_state_machine(rows):
    states, words, labels = [0, 1, 2, 3, None], [None, 0, 49, 50, 51], ["OLD", None]
    data = [(i, s, w, x, 0.1) for i, (s, w, x) in enumerate(itertools.product(states, words, labels))]
    frame = rows("i int, state int, words int, label string, score double", *data)
    out = {r.i: r for r in lo.stateful_score(frame, fixed_scorer, "words", "label", "score", "state").collect()}
    assert len(out) == len(data)
    for i, state, count, label, score in data:
        got = (out[i].label, out[i].score, out[i].state)
        if state != 0:
            assert got == (label, score, state)
        elif count is not None and count >= 50:
            assert got == ("M", 0.9, 1)
        else:
            assert got == ("OTROS ROBOS", 0.0, 0)


def test_fold_state(rows):
    frame = rows("s int, v int", *itertools.product(range(4), range(4)))
    for r in frame.select("s", "v", lo.fold_state(F.lit(7), F.col("s"), F.col("v")).alias("x")).collect():
        expected = 1 if r.s == r.v == 1 else 2 if r.v == 1 else 3 if r.s == 1 else 7
        assert r.x == expected


def test_commission_wins_with_null_but_not_without_information(rows):
    data = [
        (i, u, m, e, c)
        for i, (u, m, e, c) in enumerate(
            itertools.product([None, "SET"], [True, False], [0, 1], [None, "SIN INFORMACION", "C"])
        )
    ]
    frame = rows("i int, u string, member boolean, estado int, c string", *data)
    frame = frame.withColumn("u_origin", F.when(F.col("u").isNotNull(), "OLD")).withColumn("p", F.lit("P"))
    out = {r.i: (r.u, r.u_origin) for r in lo.unify_commission(frame, "u", "p", "c", "member", "estado").collect()}
    for i, unified, member, estado, label in data:
        if unified:
            assert out[i] == ("SET", "OLD")
        elif member and estado == 0 and label != "SIN INFORMACION":
            assert out[i] == (label, "COMISION")
        else:
            assert out[i] == ("P", "MODEL")


def test_registry_wins_on_short_pending_text(rows):
    data = [
        (i, u, w, e, c)
        for i, (u, w, e, c) in enumerate(itertools.product([None, "SET"], [49, 50], [0, 1], [None, "REVIEW_LABEL", "R"]))
    ]
    frame = rows("i int, u string, words int, estado int, r string", *data)
    frame = frame.withColumn("u_origin", F.when(F.col("u").isNotNull(), "OLD")).withColumn("p", F.lit("P"))
    out = {r.i: (r.u, r.u_origin) for r in lo.unify_registry(frame, "u", "p", "r", "words", "estado").collect()}
    for i, unified, words, estado, label in data:
        if unified:
            assert out[i] == ("SET", "OLD")
        elif words < 50 and estado == 0 and label != "REVIEW_LABEL":
            assert out[i] == (label, "SIAF")
        else:
            assert out[i] == ("P", "MODEL")


def test_mapping(rows):
    raw = [(" robo de vehículos ",), ("ROBO A BIENES DE INSTITUCION PUBLICA",), ("OTRA",), (None,), ("ROBO DE MOTOS",), ("Abigeato",)]
    out = lo.map_category(lo.map_category(rows("r string", *raw), "r", "s", "seguimiento"), "r", "v", "validados")
    got = {x.r: (x.s, x.v) for x in out.collect()}
    assert got[" robo de vehículos "] == ("ROBO DE CARROS", "ROBO DE CARROS")
    assert got["ROBO A BIENES DE INSTITUCION PUBLICA"] == ("OTROS ROBOS", "ROBO EN INSTITUCIONES PUBLICAS")
    assert got["OTRA"] == ("OTRA", "OTRA") and got[None] == (None, None)
    assert got["ROBO DE MOTOS"] == ("ROBO DE MOTOS", "ROBO DE MOTOS")
    assert got["Abigeato"] == ("REVIEW_LABEL", "REVIEW_LABEL")


def test_mapping_targets_are_scheme_labels():
    for raw, seguimiento, validados in vocab.REGISTRY_MAPPING:
        assert seguimiento in (*vocab.SEGUIMIENTO, "REVIEW_LABEL"), raw
        assert validados in (*vocab.VALIDADOS, "REVIEW_LABEL"), raw


LEXICON = sc.Lexicon([("a", "X", 2), ("b", "X", 1), ("b", "Y", 3), ("c", "Y", 2), ("d", "Z", 1)])
TEXTS = [("1", "a a b"), ("2", "b q q"), ("3", "a c"), ("4", "q"), ("5", None), ("6", ""), ("7", "d d d d a")]


def brute(text):
    if text is None:
        return (None, None)
    sums = {}
    for token in text.split(" "):
        for t, label, weight in LEXICON.entries:
            if t == token:
                sums[label] = sums.get(label, 0) + weight
    if not sums:
        return ("OTROS ROBOS", 0.0)
    best = min(sums, key=lambda k: (-sums[k], k))
    return (best, sums[best] / sum(sums.values()))


def test_lexicon_inline_and_joined_agree_with_brute_force(spark, rows):
    frame = rows("k string, t string", *TEXTS)
    expected = {k: brute(t) for k, t in TEXTS}
    inline = sc.score_with_lexicon(frame, "t", LEXICON, "l", "s")
    assert {r.k: (r.l, r.s) for r in inline.collect()} == expected
    table = spark.createDataFrame(list(LEXICON.entries), "token string, label string, weight int")
    joined = sc.score_with_lexicon_table(frame, "k", "t", table, "l", "s")
    assert {r.k: (r.l, r.s) for r in joined.collect()} == expected
    some = sc.score_with_lexicon(frame, "t", LEXICON, "l", "s", F.col("k") > "3")
    assert {r.k: (r.l, r.s) for r in some.collect()} == {k: v if k > "3" else (None, None) for k, v in expected.items()}


def test_lexicon_tokens_may_hold_quotes(rows):
    lexicon = sc.Lexicon([("l'an", "d'X", 1), ("a\\b", "Y", 2)])
    out = sc.score_with_lexicon(rows("k int, t string", (1, "l'an"), (2, "a\\b c")), "t", lexicon, "l", "s")
    assert {r.k: (r.l, r.s) for r in out.collect()} == {1: ("d'X", 1.0), 2: ("Y", 1.0)}


def test_lexicon_limits():
    with pytest.raises(ValueError):
        sc.Lexicon([("a", "X", 0)])
    assert len(sc.Lexicon([(str(i), "X", 1) for i in range(5001)]).tokens) == 5001


def last_word_model():
    """A model that answers with the last word it sees: a cut text would show."""

    def load():
        return lambda texts: [(t.split(" ")[-1], 0.5) for t in texts]

    return load


def test_plug_in_model_sees_whole_texts(rows):
    long = " ".join(["x"] * 5000 + ["end"])
    frame = rows("k int, t string", (1, "a b"), (2, None), (3, long), (4, "skip me"))
    out = sc.plug_in_score(frame, "t", last_word_model(), "l", "s", only=F.col("k") < 4)
    assert {r.k: (r.l, r.s) for r in out.collect()} == {1: ("b", 0.5), 2: (None, None), 3: ("end", 0.5), 4: (None, None)}


def test_plug_in_windows_vote_by_length(rows):
    frame = rows("k int, t string", (1, "n n a n n b n b"), (2, "a"))
    out = sc.plug_in_score(frame, "t", last_word_model(), "l", "s", window_words=3)
    got = {r.k: (r.l, round(r.s, 6)) for r in out.collect()}
    # windows "n n a", "n n b", "n b": a has 3/8 of the words, b has 5/8
    assert got == {1: ("b", round(0.5 * 5 / 8, 6)), 2: ("a", 0.5)}


def test_update_copies_nulls_and_keeps_unmatched(rows):
    target = rows("k string, a string, b int", ("1", "old", 1), ("2", "old", 2), (None, "old", 3))
    source = rows("k string, a string, t int", ("1", "first", 1), ("1", None, 2), ("9", "x", 1), (None, "y", 1))
    out = sn.update_from(target, source, "k", ["a"], [F.col("t")])
    assert {r.k: (r.a, r.b) for r in out.collect()} == {"1": (None, 1), "2": ("old", 2), None: ("old", 3)}


def test_merge_snapshots(rows):
    schema = "NDD string, delitos_seguimiento string, score_delitos_seguimiento double, delitos_validados string, score_delitos_validados double, extra int"
    current = rows(schema, ("1", "N", 0.9, "N", 0.9, 1), ("2", "N/A", 0.0, "N/A", 0.0, 1))
    previous = rows(
        schema.replace("extra int", "FechaActualizacion timestamp, compare string"),
    ).limit(0).unionByName(
        rows("NDD string", ("2",), ("3",)).select(
            "NDD", F.lit("OLD").alias("delitos_seguimiento"), F.lit(0.1).alias("score_delitos_seguimiento"),
            F.lit("OLDV").alias("delitos_validados"), F.lit(0.2).alias("score_delitos_validados"),
            F.lit("2020-01-01").cast("timestamp").alias("FechaActualizacion"), F.lit("OK").alias("compare"),
        )
    )
    import datetime as dt

    out = sn.merge_snapshots(
        current, previous, "NDD", ["delitos_seguimiento", "delitos_validados"], dt.datetime(2024, 1, 1), [F.col("FechaActualizacion")]
    )
    got = {r.NDD: (r.delitos_seguimiento, r.delitos_validados, r.FechaActualizacion.year, r.compare) for r in out.collect()}
    assert got == {"1": ("N", "N", 2024, "OK"), "2": ("OLD", "OLDV", 2020, "CHECK")}
    assert "extra" not in out.columns
    with pytest.raises(ValueError):
        sn.merge_snapshots(current, previous, "NDD", [], None, [])


def test_prefer_longer_source(rows):
    long, short = " ".join(["w"] * 50), "w w"
    frame = rows("i int, a string, b string", (1, long, "B"), (2, short, "B"), (3, short, None), (4, None, "B"), (5, None, None))
    out = frame.select("i", sn.prefer_longer_source(F.col("a"), F.col("b")).alias("x"))
    assert {r.i: r.x for r in out.collect()} == {1: long, 2: "B", 3: short, 4: "B", 5: None}
