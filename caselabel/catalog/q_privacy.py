"""Masks and id quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselabel.catalog import roles as ro
from caselabel.catalog.registry import query
from caselabel.functions import people as pp
from caselabel.functions import text as tx
from caselabel.operators import privacy as pv


def _turned_sql(value: str, rounds: str, sign: str) -> str:
    """Ten rounds over the halves of 15 digits: seven and eight."""
    step = "CAST('0x' || substring(sha256('{secret}' || r[1] || ':' || h[{other}]), 1, 15) AS BIGINT) % {size}"
    high = step.format(secret=ro.SECRET, other=2, size=10**7)
    low = step.format(secret=ro.SECRET, other=1, size=10**8)
    number = f"CAST({value} AS BIGINT)"
    turned = f"""list_reduce([[{number} // 100000000, {number} % 100000000]] || [[x, 0] FOR x IN {rounds}], lambda h, r: CASE WHEN r[1] % 2 = 0
      THEN [(h[1] {sign} {high} + 10000000) % 10000000, h[2]] ELSE [h[1], (h[2] {sign} {low} + 100000000) % 100000000] END)"""
    return f"list_transform([{turned}], lambda h: lpad(CAST(h[1] * 100000000 + h[2] AS VARCHAR), 15, '0'))[1]"


def _mask_sql(value: str) -> str:
    return _turned_sql(value, "[0, 1, 2, 3, 4, 5, 6, 7, 8, 9]", "+")


@query("mask_key", f'SELECT NDD, {_mask_sql("NDD")} AS "NDD_MASKED" FROM (SELECT {ro.KEY.format("l_orderkey")} AS NDD FROM lineitem)')
def mask_key(t):
    lines = t.lineitem.select(tx.zero_pad_key(F.col("l_orderkey").cast("string")).alias("NDD"))
    return pv.mask_key(lines, "NDD", ro.SECRET)


@query(
    "unmask_key",
    f"""SELECT o_orderkey, {ro.KEY.format("o_orderkey")} AS mask, {_turned_sql(ro.KEY.format("o_orderkey"), "[9, 8, 7, 6, 5, 4, 3, 2, 1, 0]", "-")} AS key,
    true AS same FROM orders""",
)
def unmask_key(t):
    """Every key taken for a mask: what it stands for, masked again, is the same."""
    keys = t.orders.select("o_orderkey", tx.zero_pad_key(F.col("o_orderkey").cast("string")).alias("mask"))
    back = pv.unmask_key(keys, "mask", ro.SECRET, "key")
    return pv.mask_key(back, "key", ro.SECRET, "_again").select("o_orderkey", "mask", "key", (F.col("_again") == F.col("mask")).alias("same"))


@query("mask_key_hex", f"SELECT c_custkey, sha256('{ro.SECRET}' || c_name) AS mascara FROM customer")
def mask_key_hex(t):
    return t.customer.select("c_custkey", pp.masked_hex(F.col("c_name"), ro.SECRET).alias("mascara"))


@query("mask_names", f"""SELECT c_custkey, 'nombre_' || sha256('{ro.SECRET}' || c_name) AS "NOMBRE_OFUZCADO" FROM customer""")
def mask_names(t):
    return pv.mask_names(t.customer, "c_name", ro.SECRET).select("c_custkey", "NOMBRE_OFUZCADO")


@query("mask_dictionary", f'SELECT DISTINCT NDD, {_mask_sql("NDD")} AS "NDD_OFUSCADA" FROM (SELECT {ro.KEY.format("l_orderkey")} AS NDD FROM lineitem)')
def mask_dictionary(t):
    lines = t.lineitem.select(tx.zero_pad_key(F.col("l_orderkey").cast("string")).alias("NDD"))
    return pv.mask_dictionary(lines, "NDD", ro.SECRET)


@query(
    "mask_collisions",
    f"""WITH d AS (SELECT {_mask_sql('NDD')} AS m, COUNT(*) AS n FROM (SELECT {ro.KEY.format('o_orderkey')} AS NDD FROM orders) GROUP BY 1)
    SELECT CAST(sum(n) AS BIGINT) AS n_keys, COUNT(*) AS n_masks, CAST(COALESCE(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS colliding_keys FROM d""",
)
def mask_collisions(t):
    orders = t.orders.select(tx.zero_pad_key(F.col("o_orderkey").cast("string")).alias("NDD"))
    return pv.mask_collisions(pv.mask_dictionary(orders, "NDD", ro.SECRET))


# ids of every kind: well formed, too short, missing, with a letter, all zeros
_CARD = """CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL WHEN c_mktsegment = 'BUILDING' THEN CAST(c_custkey * 7919 AS {s})
  WHEN c_mktsegment = 'FURNITURE' THEN concat('A', lpad(CAST(c_custkey AS {s}), 9, '0')) ELSE lpad(CAST(c_custkey * 7919 AS {s}), 10, '0') END"""
_LUHN = """(regexp_full_match({c}, '[0-9]{{10}}') AND {c} <> '0000000000' AND
  (list_sum(list_transform(range(1, 10), lambda i: CASE WHEN i % 2 = 1 THEN CASE WHEN 2 * TRY_CAST(substring({c}, CAST(i AS INTEGER), 1) AS INTEGER) > 9
    THEN 2 * TRY_CAST(substring({c}, CAST(i AS INTEGER), 1) AS INTEGER) - 9 ELSE 2 * TRY_CAST(substring({c}, CAST(i AS INTEGER), 1) AS INTEGER) END
    ELSE TRY_CAST(substring({c}, CAST(i AS INTEGER), 1) AS INTEGER) END)) + TRY_CAST(substring({c}, 10, 1) AS INTEGER)) % 10 = 0)"""


def _quality_sql(number: str, valid: str) -> str:
    return f"""SELECT c_nationkey, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE {number} IS NULL) AS missing, COUNT(*) FILTER (WHERE {valid}) AS valid,
    COUNT(*) FILTER (WHERE {number} IS NOT NULL AND NOT COALESCE({valid}, false)) AS invalid"""


@query(
    "id_card_quality",
    f"{_quality_sql('cedula', _LUHN.format(c='cedula'))} FROM (SELECT c_nationkey, {_CARD.format(s='VARCHAR')} AS cedula FROM customer) GROUP BY 1",
)
def id_card_quality(t):
    people = t.customer.select("c_nationkey", F.expr(_CARD.format(s="STRING")).alias("cedula"))
    return pv.id_card_quality(people, "c_nationkey", "cedula")


_RUC = "CASE WHEN c_acctbal > 7000 THEN concat(cedula, '002') ELSE concat(cedula, '001') END"
_RUC_VALID = f"regexp_full_match(ruc, '[0-9]{{10}}001') AND {_LUHN.format(c='substring(ruc, 1, 10)')}"


@query(
    "tax_id_quality",
    f"""{_quality_sql('ruc', f'({_RUC_VALID})')} FROM (SELECT c_nationkey, CASE WHEN cedula IS NULL THEN NULL ELSE {_RUC} END AS ruc
    FROM (SELECT c_nationkey, c_acctbal, {_CARD.format(s='VARCHAR')} AS cedula FROM customer)) GROUP BY 1""",
)
def tax_id_quality(t):
    people = t.customer.select("c_nationkey", "c_acctbal", F.expr(_CARD.format(s="STRING")).alias("cedula"))
    return pv.tax_id_quality(people.select("c_nationkey", F.expr(_RUC).alias("ruc")), "c_nationkey", "ruc")
