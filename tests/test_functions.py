"""Truth tables of the scalar functions."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from caselabel.functions import dates as da
from caselabel.functions import labels as lb
from caselabel.functions import people as pp
from caselabel.functions import text as tx


def values(spark, column, *inputs, dtype="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {dtype}")
    return [r[0] for r in frame.orderBy("i").select(column(F.col("v"))).collect()]


def test_normalize_text(spark):
    texts = [None, "", "  Hola, MUNDO!! ", "vergüenza", "año 2023_x", "a b", "ÁÉÍÓÚÑ ç", "...\n", "ſ K"]
    def expected(t):
        return None if t is None else re.sub("[^A-Za-z0-9áéíóúñ]+", " ", t.lower()).strip()

    assert values(spark, tx.normalize_text, *texts) == [expected(t) for t in texts]


def test_normalize_text_on_every_latin_character(spark):
    text = "".join(chr(c) for c in range(1, 0x250))
    assert values(spark, tx.normalize_text, text) == [re.sub("[^A-Za-z0-9áéíóúñ]+", " ", text.lower()).strip()]


def test_word_counters(spark):
    texts = [None, "", " ", "a", "a b", "a  b", "üa b c", "x_1 y-2"]
    assert values(spark, tx.word_count_space, *texts) == [0] + [len(t.split(" ")) for t in texts[1:]]
    assert values(spark, tx.word_count_ws, *texts[:6]) == [0, 0, 0, 1, 2, 2]
    assert values(spark, tx.word_count_regex, *texts) == [0, 0, 0, 1, 2, 2, 3, 3]


def test_zero_pad_never_shortens(spark):
    keys = [None, "", "1" * 14, "2" * 15, "3" * 16, "4" * 19]
    assert values(spark, tx.zero_pad_key, *keys) == [None] + [k.zfill(15) for k in keys[1:]]


def test_strip_markup(spark):
    texts = [None, "<p>Hola&nbsp;<b>A&Ntilde;O</b> &amp; m&aacute;s</p>", "sin marcas", "a < b", "x &lt;i&gt;"]
    assert values(spark, tx.strip_markup, *texts) == [None, "hola año & más", "sin marcas", "a < b", "x <i>"]


def test_is_number(spark):
    texts = [None, "", "12", " -3.5 ", "1e5", "1d", "NaN", "12 a", ".5", "."]
    assert values(spark, tx.is_number, *texts) == [False, False, True, True, True, False, False, False, True, False]


def test_normalize_label(spark):
    texts = [None, " robo de vehículos ", "A  B", "ÁÉÍÓÚ Ü"]
    assert values(spark, lb.normalize_label, *texts) == [None, "ROBO DE VEHICULOS", "A  B", "AEIOU Ü"]


def test_agreement(rows):
    frame = rows("a string, b string", ("x", "x"), ("x", "y"), (None, None), (None, "x"))
    assert [r[0] for r in frame.select(lb.agreement(F.col("a"), F.col("b"))).collect()] == ["OK", "CHECK", "CHECK", "CHECK"]


def test_buckets(spark):
    texts = ["A", "B", None]
    assert values(spark, lambda c: lb.bucket_other(c, ["A"]), *texts) == ["A", "OTROS ROBOS", "OTROS ROBOS"]
    assert values(spark, lambda c: lb.fold_into(c, ["B"]), *texts) == ["A", "OTROS ROBOS", None]


def test_best_match(spark):
    found = values(spark, lambda c: lb.best_match(c, ["ROBO A PERSONAS", "ROBO DE MOTOS"]), "ROBO A PERSONA", "OTRA COSA", "")
    assert [r["match"] for r in found] == ["ROBO A PERSONAS", "No match found", "No match found"]
    assert found[0]["score"] == 93


def test_stage_and_state(spark):
    assert values(spark, lb.stage_text, 265, 1065, 1, None, dtype="int") == [
        "INVESTIGACION PREVIA", "IMPUGNACION", "SIN ACCIONES", "SIN ACCIONES"
    ]
    assert values(spark, lb.state_text, "X", None) == ["X", "POR APERTURAR INVETIGACION PREVIA"]
    assert values(spark, lb.yes_no, "N", "S", None) == ["No", "Si", "Si"]


def test_months_and_weekdays(spark):
    assert values(spark, da.month_short, 0, 1, 12, 13, None, dtype="int") == [None, "ene", "dic", None, None]
    assert values(spark, da.month_full, 9, dtype="int") == ["Septiembre"]
    monday = dt.date(2024, 1, 1)
    week = [monday + dt.timedelta(days=i) for i in range(7)]
    assert values(spark, da.weekday_name, *week, None, dtype="date") == [
        "LUNES", "MARTES", "MIERCOLES", "JUEVES", "VIERNES", "SABADO", "DOMINGO", None
    ]


def test_parse_date(spark):
    assert values(spark, lambda c: F.to_date(da.parse_date(c, "dd/MM/yyyy")), "31/12/2023", "2023-12-31", None) == [
        dt.date(2023, 12, 31), None, None
    ]


def test_spss_epoch(spark):
    def as_text(c):
        return F.date_format(da.from_spss(c), "yyyy-MM-dd HH:mm:ss")

    seconds = (dt.datetime(2023, 5, 6, 7, 8, 9) - dt.datetime(1582, 10, 14)).total_seconds()
    assert values(spark, as_text, seconds, None, dtype="double") == ["2023-05-06 07:08:09", None]


def test_hour_band(spark):
    times = ["00:00:00", "05:59:59", "06:00:00", "11:59:59", "12:00:00", "17:59:59", "18:00:00", "23:59:59", "05:59:59.5", "7:05", "24:00", "xx", None]
    assert values(spark, da.hour_band, *times) == [
        "00:00 - 05:59", "00:00 - 05:59", "06:00 - 11:59", "06:00 - 11:59", "12:00 - 17:59", "12:00 - 17:59",
        "18:00 - 23:59", "18:00 - 23:59", "00:00 - 05:59", "06:00 - 11:59", "S.D.", "S.D.", "S.D.",
    ]


def test_duration_text(spark):
    seconds = 3 * 86400 + 17 * 3600 + 9 * 60 + 41
    assert values(spark, da.duration_text, seconds, 0, None, dtype="bigint") == ["03d 17h 09m 41s", "00d 00h 00m 00s", None]
    assert values(spark, lambda c: da.duration_text(c, "{H}h {S}s"), 30 * 3600 + 90, dtype="bigint") == ["30h 90s"]
    weeks = 2 * 604800 + 86400 + 23 * 3600 + 7
    assert values(spark, lambda c: da.duration_text(c, "{W}w {D}d {H}:{M:02}:{S:02}"), weeks, dtype="bigint") == ["2w 1d 23:00:07"]
    assert values(spark, lambda c: da.duration_text(c, "{D:2}d"), seconds, dtype="bigint") == [" 3d"]
    for unit, count in (("m", 90.0), ("H", 1.5), ("d", 0.0625), ("w", 0.0625 / 7)):
        assert values(spark, lambda c, u=unit: da.duration_text(c, "{H}:{M:02}", u), count, dtype="double") == ["1:30"]
    with pytest.raises(ValueError):
        da.duration_text(F.col("x"), unit="y")


def test_ages(spark):
    ages = [-1.0, 0.0, 11.0, 11.5, 12.0, 17.0, 18.0, 64.0, 65.0, 100.0, 101.0, None]
    none = "SIN INFORMACION"
    assert values(spark, pp.age_group, *ages, dtype="double") == [
        none, "NIÑ@S (DE 0 A 11 AÑOS)", "NIÑ@S (DE 0 A 11 AÑOS)", none, "ADOLESCENTES (DE 12 A 17 AÑOS)",
        "ADOLESCENTES (DE 12 A 17 AÑOS)", "JÓVENES (DE 18 A 29 AÑOS)", "ADULTOS (DE 30 A 64 AÑOS)",
        "ADULTOS MAYORES (DESDE 65 AÑOS)", "ADULTOS MAYORES (DESDE 65 AÑOS)", none, none,
    ]
    band = values(spark, pp.age_band, *ages, 14.9, 15.0, 24.9, 25.0, 35.0, 45.0, dtype="double")
    assert band[0] == band[10] == band[11] == none
    assert band[1] == band[3] == band[12] == "MENORES DE 15 AÑOS"
    assert band[13:] == ["ENTRE 15 Y 24 AÑOS", "ENTRE 15 Y 24 AÑOS", "ENTRE 25 Y 34 AÑOS", "ENTRE 35 Y 44 AÑOS", "ENTRE 45 Y 64 AÑOS"]
    assert band[8] == band[9] == "MAYORES DE 65 AÑOS"
    minor = values(spark, pp.is_minor, *ages, dtype="double")
    assert minor == [none] + ["MENOR DE EDAD"] * 5 + ["MAYOR DE EDAD"] * 5 + [none]


def luhn(number: str) -> bool:
    digits = [int(c) for c in number]
    doubled = [d if i % 2 == len(digits) % 2 == 1 else d for i, d in enumerate(digits)]
    total = 0
    for i, d in enumerate(reversed(doubled)):
        total += sum(divmod(2 * d, 10)) if i % 2 else d
    return total % 10 == 0


def test_id_cards_against_luhn(spark):
    rng = random.Random(1)
    cards = ["".join(rng.choice("0123456789") for _ in range(10)) for _ in range(3000)]
    assert values(spark, pp.valid_id_card, *cards) == [luhn(c) for c in cards]
    assert values(spark, pp.valid_id_card, None, "", "0" * 10, "123", "1" * 11, "12345abcde") == [False] * 6


def test_tax_ids(spark):
    good = "1710034065"
    assert luhn(good)
    assert values(spark, pp.valid_tax_id, good + "001", good + "002", good, None, "1710034066001") == [True, False, False, False, False]


def test_masks(spark):
    keys = ["000000000000001", "000000000000002", None]
    first = values(spark, lambda c: pp.masked_digits(c, "s"), *keys)
    assert first == values(spark, lambda c: pp.masked_digits(c, "s"), *keys)
    assert first != values(spark, lambda c: pp.masked_digits(c, "other"), *keys)
    assert all(re.fullmatch(r"\d{15}", m) for m in first[:2]) and first[0] != first[1] and first[2] is None
    assert values(spark, lambda c: pp.masked_name(c, "s"), "Ana")[0].startswith("nombre_")
    with pytest.raises(ValueError):
        pp.masked_digits(F.col("x"), "")


def test_references_against_the_standard_library(spark):
    import html
    import random

    names = list(html.entities.html5)
    rng = random.Random(1)
    texts = [f"a&{n}b" for n in names] + [f"&{n.rstrip(';')}" for n in names] + [f"&{n};x" for n in names if not n.endswith(";")]
    numbers = [*range(400), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x10FFFF, 0x110000, 99999999, 10**25]
    texts += [f"&#{i};" for i in numbers] + [f"&#x{i:x}z" for i in numbers] + [f"&#X0{i:X};" for i in numbers]
    texts += ["&", "&&", "&#", "&#;", "&#x;", "&#xg", "& amp;", "&amp", "&notit;", "&NOTIT", "", "no", "&" + "a" * 40 + ";", "&amp;amp;", "&\n", "&ampé;"]
    pieces = ["&", "#", "x", "1", "a", "amp", "lt;", "not", "in;", ";", " ", "é", "notin", "&#", "&#x", "0", "9f", "8364"]
    texts += ["".join(rng.choices(pieces, k=rng.randrange(1, 9))) for _ in range(2000)]
    assert values(spark, tx.unescape, *texts) == [html.unescape(t) for t in texts]
    assert values(spark, tx.unescape, None, "x") == [None, "x"]
    assert values(spark, tx.unescape, "&lt;" * 50_000) == ["<" * 50_000]


def test_elements(spark):
    cases = {
        'a<b title="x > y">c</b>d': "acd",
        "a<!-- <b> > -->b": "ab",
        "x<SCRIPT type='t'>if (a < b) { y }</Script >z": "xz",
        "x<style>\np > q {}\n</style>z<br/>w": "xzw",
        "a < b and c > d": "a < b and c > d",
        "a <b": "a <b",
        "<!-- open": "<!-- open",
        "<a href='x>y": "<a href='x>y",
        "<!DOCTYPE html><p>t": "t",
        "<script>open": "open",
        "1<2>3": "1<2>3",
    }
    assert values(spark, tx.strip_elements, *cases) == list(cases.values())
    assert values(spark, tx.strip_elements, None, "", '<a b="' + "x" * 500_000 + '">y') == [None, "", "y"]


def test_blanks_of_every_kind(spark):
    text = "\u00a0 uno\u2003dos\t\n tres\x0bcuatro\u00a0"
    assert values(spark, tx.word_count_ws, text, "\u00a0", None) == [4, 0, 0]
    assert values(spark, tx.collapse_spaces, text) == ["uno dos tres cuatro"]
    assert values(spark, lb.normalize_label, " \tRobo  de vehículos\n\u00a0") == ["ROBO  DE VEHICULOS"]
