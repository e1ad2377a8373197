"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.catalog import roles as ro
from caselabel.catalog.registry import query
from caselabel.functions import dates as da
from caselabel.functions import labels as lb
from caselabel.functions import people as pp
from caselabel.functions import text as tx
from caselabel.operators import filters as fl
from caselabel.operators import labels as lo

WITH_NORM = f"WITH {ro.NORM_SQL}"


@query("normalize_text", f"{WITH_NORM} SELECT NDD, RELATO FROM norm")
def normalize_text(t):
    return t.cases().select("NDD", tx.normalize_text(F.col("RELATO")).alias("RELATO"))


@query("strip_markup")
def strip_markup(t):
    return t.pages.select("page_id", tx.strip_markup(F.col("html")).alias("texto"))


_ELEMENTS_SQL = r"""(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|</?[a-z!?](?:[^>"'']|"[^"]*"|''[^'']*'')*>"""


@query("strip_elements", f"SELECT page_id, regexp_replace(html, '{_ELEMENTS_SQL}', '', 'g') AS texto FROM pages")
def strip_elements(t):
    return t.pages.select("page_id", tx.strip_elements(F.col("html")).alias("texto"))


@query("strip_tags", "SELECT page_id, lower(regexp_replace(html, '<[^>]*>', '', 'g')) AS texto FROM pages")
def strip_tags(t):
    return t.pages.select("page_id", F.lower(tx.strip_tags(F.col("html"))).alias("texto"))


@query(
    "normalize_label",
    f"""SELECT NDD, {ro.norm_label_sql('DELITO_DESAGREGACION')} AS etiqueta FROM ({ro.CASES_SQL})
    UNION ALL SELECT NDD, {ro.norm_label_sql('delitos_seguimiento')} FROM ({ro.COMMISSION_RAW_SQL})""",
)
def normalize_label(t):
    first = t.cases().select("NDD", lb.normalize_label(F.col("DELITO_DESAGREGACION")).alias("etiqueta"))
    return first.unionByName(t.commission_raw().select("NDD", lb.normalize_label(F.col("delitos_seguimiento")).alias("etiqueta")))


@query("word_count_space", f"SELECT NDD, CAST(COALESCE(len(string_split(RELATO, ' ')), 0) AS INTEGER) AS palabras FROM ({ro.CASES_SQL})")
def word_count_space(t):
    return t.cases().select("NDD", tx.word_count_space(F.col("RELATO")).alias("palabras"))


@query(
    "word_count_ws",
    f"SELECT NDD, CAST(COALESCE(len(list_filter(regexp_split_to_array(RELATO, '{ro.BLANKS}+'), lambda x: x <> '')), 0) AS INTEGER) AS palabras FROM ({ro.CASES_SQL})",
)
def word_count_ws(t):
    return t.cases().select("NDD", tx.word_count_ws(F.col("RELATO")).alias("palabras"))


@query(
    "word_count_regex",
    f"SELECT NDD, CAST(COALESCE(len(regexp_extract_all(RELATO, '[\\p{{L}}\\p{{N}}_]+')), 0) AS INTEGER) AS palabras FROM ({ro.CASES_SQL})",
)
def word_count_regex(t):
    return t.cases().select("NDD", tx.word_count_regex(F.col("RELATO")).alias("palabras"))


@query("collapse_spaces", f"SELECT NDD, trim(regexp_replace(RELATO, '{ro.BLANKS}+', ' ', 'g')) AS RELATO FROM ({ro.CASES_SQL})")
def collapse_spaces(t):
    return t.cases().select("NDD", tx.collapse_spaces(F.col("RELATO")).alias("RELATO"))


@query(
    "map_category",
    f"""SELECT c.NDD, COALESCE(s.label, {ro.norm_label_sql('DELITO_DESAGREGACION')}) AS seguimiento,
    COALESCE(v.label, {ro.norm_label_sql('DELITO_DESAGREGACION')}) AS validados FROM ({ro.CASES_SQL}) c
    LEFT JOIN (SELECT * FROM {ro.mapping_sql('seguimiento')}) s ON s.raw_label = {ro.norm_label_sql('DELITO_DESAGREGACION')}
    LEFT JOIN (SELECT * FROM {ro.mapping_sql('validados')}) v ON v.raw_label = {ro.norm_label_sql('DELITO_DESAGREGACION')}""",
)
def map_category(t):
    cases = t.cases().select("NDD", "DELITO_DESAGREGACION")
    for scheme in vocab.SCHEMES:
        cases = lo.map_category(cases, "DELITO_DESAGREGACION", scheme, scheme)
    return cases.drop("DELITO_DESAGREGACION")


_KEEP = ("ROBO A PERSONAS", "ROBO DE CARROS", "ROBO A DOMICILIO")
_MINOR = ("ROBO OTROS", "ROBO A EMBARCACIONES")
_IN_KEEP = ", ".join(f"'{k}'" for k in _KEEP)
_IN_MINOR = ", ".join(f"'{k}'" for k in _MINOR)


@query(
    "bucket_other",
    f"""SELECT NDD, CASE WHEN etiqueta IN ({_IN_KEEP}) THEN etiqueta ELSE 'OTROS ROBOS' END AS grupo
    FROM (SELECT NDD, {ro.norm_label_sql('DELITO_DESAGREGACION')} AS etiqueta FROM ({ro.CASES_SQL}))""",
)
def bucket_other(t):
    return t.cases().select("NDD", lb.bucket_other(lb.normalize_label(F.col("DELITO_DESAGREGACION")), _KEEP).alias("grupo"))


@query(
    "fold_minor_labels",
    f"""SELECT NDD, CASE WHEN etiqueta IN ({_IN_MINOR}) THEN 'OTROS ROBOS' ELSE etiqueta END AS grupo
    FROM (SELECT NDD, {ro.norm_label_sql('DELITO_DESAGREGACION')} AS etiqueta FROM ({ro.CASES_SQL}))
    WHERE etiqueta IN ({_IN_KEEP}, {_IN_MINOR})""",
)
def fold_minor_labels(t):
    named = t.cases().select("NDD", lb.normalize_label(F.col("DELITO_DESAGREGACION")).alias("etiqueta"))
    listed = named.where(F.col("etiqueta").isin(*_KEEP, *_MINOR))
    return listed.select("NDD", lb.fold_into(F.col("etiqueta"), _MINOR).alias("grupo"))


@query("ascii_only", f"SELECT NDD, regexp_replace(RELATO, '[^\\x00-\\x7F]', '', 'g') AS RELATO FROM ({ro.CASES_SQL})")
def ascii_only(t):
    return t.cases().select("NDD", tx.ascii_only(F.col("RELATO")).alias("RELATO"))


@query(
    "zero_pad_key",
    """SELECT c_name, CASE WHEN length(c_name) >= 15 THEN c_name ELSE lpad(c_name, 15, '0') END AS clave,
    lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS numero FROM customer""",
)
def zero_pad_key(t):
    return t.customer.select(
        "c_name",
        tx.zero_pad_key(F.col("c_name")).alias("clave"),
        tx.zero_pad_key(F.col("c_custkey").cast("string")).alias("numero"),
    )


_TOKENS_SQL = "SELECT DISTINCT unnest(string_split(text, ' ')) AS texto FROM documents"


@query(
    "non_text_rows",
    f"SELECT texto FROM ({_TOKENS_SQL}) WHERE regexp_full_match(texto, '\\s*[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*')",
)
def non_text_rows(t):
    pieces = t.documents.select(F.explode(F.split("text", " ")).alias("texto"))
    return fl.non_text_rows(pieces, "texto").distinct()


def _names_sql(names, expr: str) -> str:
    return "CASE " + expr + " " + " ".join(f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(names)) + " END"


@query(
    "month_names",
    f"""SELECT p_partkey, p_size, {_names_sql(vocab.MONTHS_SHORT, 'p_size')} AS mes_abrv, {_names_sql(vocab.MONTHS_FULL, 'p_size')} AS mes_cmpl FROM part""",
)
def month_names(t):
    size = F.col("p_size")
    return t.part.select("p_partkey", "p_size", da.month_short(size).alias("mes_abrv"), da.month_full(size).alias("mes_cmpl"))


@query(
    "parse_date",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%d/%m/%Y') END AS fecha FROM orders""",
)
def parse_date(t):
    raw = F.when(F.col("o_orderstatus") == "P", F.lit("sin fecha")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    parsed = da.parse_date(raw, "dd/MM/yyyy")
    return t.orders.select("o_orderkey", F.date_format(parsed, "dd/MM/yyyy").alias("fecha"))


@query(
    "month_year",
    "SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS mes, CAST(year(o_orderdate) AS INTEGER) AS anio FROM orders",
)
def month_year(t):
    return t.orders.select("o_orderkey", F.month("o_orderdate").alias("mes"), F.year("o_orderdate").alias("anio"))


@query(
    "weekday_names",
    f"""SELECT event_id, CAST(isodow(ts) - 1 AS INTEGER) AS dia_num, {_names_sql(vocab.WEEKDAYS, 'isodow(ts)')} AS dia_nombre FROM events""",
)
def weekday_names(t):
    return t.events.select("event_id", F.weekday("ts").alias("dia_num"), da.weekday_name(F.col("ts")).alias("dia_nombre"))


@query(
    "spss_timestamp",
    """SELECT event_id, strftime(TIMESTAMP '1582-10-14 00:00:00' + to_seconds(13600000000 + event_id * 7919), '%Y-%m-%d %H:%M:%S') AS fecha FROM events""",
)
def spss_timestamp(t):
    seconds = (F.lit(13_600_000_000) + F.col("event_id") * 7919).cast("double")
    return t.events.select("event_id", F.date_format(da.from_spss(seconds), "yyyy-MM-dd HH:mm:ss").alias("fecha"))


@query(
    "hour_band",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'S.D.' WHEN hour(ts) < 6 THEN '00:00 - 05:59' WHEN hour(ts) < 12 THEN '06:00 - 11:59'
    WHEN hour(ts) < 18 THEN '12:00 - 17:59' ELSE '18:00 - 23:59' END AS banda FROM events""",
)
def hour_band(t):
    short = F.concat(F.hour("ts").cast("string"), F.lit(":"), F.date_format("ts", "mm"))
    time = (
        F.when(F.col("event_type") == "error", "sin hora")
        .when(F.col("event_type") == "view", F.date_format("ts", "HH:mm:ss.SSSSSS"))
        .when(F.col("event_type") == "purchase", short)
        .otherwise(F.date_format("ts", "HH:mm:ss"))
    )
    return t.events.select("event_id", da.hour_band(time).alias("banda"))


# ages from -9.99 upwards, with fractions and gaps
_AGE_SQL = "CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL WHEN c_mktsegment = 'BUILDING' THEN c_acctbal / 100 ELSE floor(c_acctbal / 100) END"


def ages(t):
    raw = F.col("c_acctbal") / 100
    age = F.when(F.col("c_mktsegment") == "FURNITURE", None).when(F.col("c_mktsegment") == "BUILDING", raw).otherwise(F.floor(raw))
    return t.customer.select("c_custkey", age.cast("double").alias("edad"))


@query(
    "age_group_a",
    f"""SELECT c_custkey, CASE WHEN edad >= 0 AND edad <= 11 THEN 'NIÑ@S (DE 0 A 11 AÑOS)' WHEN edad >= 12 AND edad <= 17 THEN 'ADOLESCENTES (DE 12 A 17 AÑOS)'
    WHEN edad >= 18 AND edad <= 29 THEN 'JÓVENES (DE 18 A 29 AÑOS)' WHEN edad >= 30 AND edad <= 64 THEN 'ADULTOS (DE 30 A 64 AÑOS)'
    WHEN edad >= 65 AND edad <= 100 THEN 'ADULTOS MAYORES (DESDE 65 AÑOS)' ELSE 'SIN INFORMACION' END AS grupo
    FROM (SELECT c_custkey, {_AGE_SQL} AS edad FROM customer)""",
)
def age_group_a(t):
    return ages(t).select("c_custkey", pp.age_group(F.col("edad")).alias("grupo"))


@query(
    "age_group_b",
    f"""SELECT c_custkey, CASE WHEN edad >= 0 AND edad < 15 THEN 'MENORES DE 15 AÑOS' WHEN edad >= 15 AND edad < 25 THEN 'ENTRE 15 Y 24 AÑOS'
    WHEN edad >= 25 AND edad < 35 THEN 'ENTRE 25 Y 34 AÑOS' WHEN edad >= 35 AND edad < 45 THEN 'ENTRE 35 Y 44 AÑOS'
    WHEN edad >= 45 AND edad < 65 THEN 'ENTRE 45 Y 64 AÑOS' WHEN edad >= 65 AND edad <= 100 THEN 'MAYORES DE 65 AÑOS' ELSE 'SIN INFORMACION' END AS grupo
    FROM (SELECT c_custkey, {_AGE_SQL} AS edad FROM customer)""",
)
def age_group_b(t):
    return ages(t).select("c_custkey", pp.age_band(F.col("edad")).alias("grupo"))


@query(
    "is_minor",
    f"""SELECT c_custkey, CASE WHEN edad >= 0 AND edad < 18 THEN 'MENOR DE EDAD' WHEN edad >= 18 THEN 'MAYOR DE EDAD' ELSE 'SIN INFORMACION' END AS grupo
    FROM (SELECT c_custkey, {_AGE_SQL} AS edad FROM customer)""",
)
def is_minor(t):
    return ages(t).select("c_custkey", pp.is_minor(F.col("edad")).alias("grupo"))


_ROLE_SQL = """CASE l_linenumber WHEN 1 THEN 'VICTIMA' WHEN 2 THEN 'DENUNCIANTE' WHEN 3 THEN 'SOSPECHOSO NO RECONOCIDO' WHEN 4 THEN 'PERITO'
  WHEN 5 THEN 'VICTIMA-DENUNCIANTE' WHEN 6 THEN 'DETENIDO' END"""


@query(
    "party_role",
    f"""SELECT l_orderkey, raw_role, role FROM (SELECT l_orderkey, {_ROLE_SQL} AS raw_role FROM lineitem) p
    LEFT JOIN (SELECT raw AS raw_role, role FROM {ro.values_sql([(raw, role) for role, raws in vocab.PARTY_ROLES.items() for raw in raws], 'raw, role')}) r USING (raw_role)""",
)
def party_role(t):
    parties = t.lineitem.select("l_orderkey", F.expr(_ROLE_SQL).alias("raw_role"))
    roles = F.broadcast(vocab.party_role_table(t.spark))
    return parties.join(roles, "raw_role", "left").select("l_orderkey", "raw_role", "role")


def _duration_sql(seconds: str) -> str:
    return f"""printf('%02dd %02dh %02dm %02ds', {seconds} // 86400, ({seconds} % 86400) // 3600, ({seconds} % 3600) // 60, {seconds} % 60)"""


@query(
    "duration_text",
    f"""SELECT p_partkey, {_duration_sql('s')} AS dhms, printf('%dh %ds', s // 3600, s % 3600) AS hs,
    printf('%dw %dd', s // 604800, (s % 604800) // 86400) AS wd, printf('%dd %dh', s * 60 // 86400, (s * 60 % 86400) // 3600) AS de_minutos FROM (SELECT p_partkey, CAST(p_retailprice * 100 AS BIGINT) * 7 AS s FROM part)""",
)
def duration_text(t):
    seconds = F.col("s")
    parts = t.part.select("p_partkey", (F.round(F.col("p_retailprice") * 100).cast("bigint") * 7).alias("s"))
    return parts.select(
        "p_partkey",
        da.duration_text(seconds).alias("dhms"),
        da.duration_text(seconds, "{H}h {S}s").alias("hs"),
        da.duration_text(seconds, "{W}w {D}d").alias("wd"),
        da.duration_text(seconds, "{D}d {H}h", unit="m").alias("de_minutos"),
    )


@query(
    "lookup_case",
    f"""SELECT NDD, fso_orden, CASE fso_etapas WHEN 265 THEN 'INVESTIGACION PREVIA' WHEN 266 THEN 'INSTRUCCION FISCAL' WHEN 267 THEN 'PREPARATORIA DE JUICIO'
    WHEN 268 THEN 'JUICIO' WHEN 1065 THEN 'IMPUGNACION' ELSE 'SIN ACCIONES' END AS etapa,
    COALESCE(r_name, 'POR APERTURAR INVETIGACION PREVIA') AS estado, CASE WHEN fso_acumulado = 'F' THEN 'No' ELSE 'Si' END AS acumulado
    FROM ({ro.ASSIGNMENTS_SQL}) LEFT JOIN region ON r_regionkey = estado_procesal""",
)
def lookup_case(t):
    coded = t.assignments().join(t.states(), "estado_procesal", "left")
    return coded.select(
        "NDD",
        "fso_orden",
        lb.stage_text(F.col("fso_etapas")).alias("etapa"),
        lb.state_text(F.col("descripcion_estado")).alias("estado"),
        lb.yes_no(F.col("fso_acumulado"), "F").alias("acumulado"),
    )
