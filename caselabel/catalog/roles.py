"""The given tables in the roles the operators expect, in Spark and in SQL.

Every role reads whole tables; derived columns (state, registry label, earlier
prediction) follow from a row's own attributes.  The SQL texts are written for
an independent engine and mirror the derivations, not the operators.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.functions import text as tx
from caselabel.operators import keys as ky
from caselabel.operators.cases import CaseTables
from caselabel.operators.scoring import Lexicon, score_with_lexicon
from caselabel.sources.tables import read_commission, read_table

RUN_TIME = dt.datetime(2024, 2, 1, 8, 0, 0)
SECRET = "not-a-real-secret"

# Evidence tokens for the test texts, (token, label, weight).
SEGUIMIENTO_ENTRIES = (
    ("the", "ROBO A DOMICILIO", 2),
    ("of", "ROBO A DOMICILIO", 1),
    ("and", "ROBO A PERSONAS", 3),
    ("to", "ROBO A PERSONAS", 2),
    ("in", "ROBO A PERSONAS", 1),
    ("is", "ROBO DE CARROS", 3),
    ("that", "ROBO DE CARROS", 3),
    ("it", "ROBO DE CARROS", 2),
    ("la", "ROBO DE MOTOS", 2),
    ("que", "ROBO DE MOTOS", 3),
    ("der", "ROBO A UNIDADES ECONOMICAS", 3),
    ("die", "ROBO A UNIDADES ECONOMICAS", 2),
    ("le", "ROBO DE BIENES, ACCESORIOS Y AUTOPARTES DE VEHICULOS", 2),
    ("des", "ROBO DE BIENES, ACCESORIOS Y AUTOPARTES DE VEHICULOS", 3),
    ("et", "ROBO DE BIENES, ACCESORIOS Y AUTOPARTES DE VEHICULOS", 2),
    ("con", "OTROS ROBOS", 1),
)
VALIDADOS_ENTRIES = (
    ("the", "ROBO A DOMICILIO", 1),
    ("of", "ROBO A DOMICILIO", 2),
    ("and", "ROBO A PERSONAS", 2),
    ("for", "ROBO EN INSTITUCIONES PUBLICAS", 3),
    ("on", "ROBO A INSTITUCIONES EDUCATIVAS", 3),
    ("is", "ROBO DE CARROS", 2),
    ("that", "ROBO DE CARROS", 2),
    ("was", "ROBO A EMBARCACIONES DE ESPACIOS ACUATICOS", 3),
    ("la", "ROBO DE MOTOS", 1),
    ("de", "ROBO DE MOTOS", 1),
    ("und", "ROBO A UNIDADES ECONOMICAS", 3),
    ("der", "ROBO A UNIDADES ECONOMICAS", 1),
    ("le", "ROBO DE BIENES, ACCESORIOS Y AUTOPARTES DE VEHICULOS", 2),
    ("en", "ROBO A ESTABLECIMIENTOS DE COLECTIVOS U ORGANIZACIONES SOCIALES", 2),
    ("con", "OTROS ROBOS", 1),
)
LEXICONS = {
    "seguimiento": Lexicon(SEGUIMIENTO_ENTRIES),
    "validados": Lexicon(VALIDADOS_ENTRIES),
}

# --- derived columns, in SQL that both engines read ---------------------------
_REGISTRY_LABEL = """CASE CAST(n_chars % 12 AS INTEGER)
    WHEN 0 THEN 'ROBO DE VEHÍCULOS'
    WHEN 1 THEN ' robo domicilios '
    WHEN 2 THEN 'NO_APLICA'
    WHEN 3 THEN 'RECEPTACION'
    WHEN 4 THEN 'ROBO A BANCOS - ENTIDADES  FINANCIERAS'
    WHEN 5 THEN 'ROBO A PERSONAS'
    WHEN 6 THEN 'ROBO DE BIENES A ENTIDAD PÚBLICA'
    WHEN 7 THEN 'Hurto a Personas'
    WHEN 8 THEN 'ROBO A EMBARCACIONES'
    WHEN 9 THEN 'ROBO EN VIAS O CARRETERAS'
    WHEN 10 THEN 'ROBO OTROS' END"""
_SOURCE = "CAST(substring(source, 4) AS INTEGER)"
_STATE = f"CASE WHEN {_SOURCE} < 10 THEN 0 WHEN {_SOURCE} < 14 THEN 1 WHEN {_SOURCE} < 17 THEN 2 ELSE 3 END"
_PRIOR = "CASE lang WHEN 'en' THEN 'ROBO A PERSONAS' WHEN 'fr' THEN 'ROBO DE CARROS' WHEN 'de' THEN 'ROBO DE MOTOS' END"
_PRIOR_SCORE = "round(n_chars / (n_chars + 100.0), 6)"
CASE_COLUMNS = {
    "RELATO": "CASE WHEN lang = 'de' AND source IN ('src4', 'src9', 'src12') THEN NULL ELSE text END",
    "ESTADO_ML": _STATE,
    "DELITO_DESAGREGACION": _REGISTRY_LABEL,
    "delitos_seguimiento_predicted": f"CASE WHEN {_STATE} <> 0 THEN {_PRIOR} END",
    "delitos_seguimiento_predicted_score": f"CASE WHEN {_STATE} <> 0 THEN CAST({_PRIOR_SCORE} AS DOUBLE) END",
    "delitos_validados_predicted": f"CASE WHEN {_STATE} IN (1, 2) THEN {_PRIOR} END",
    "delitos_validados_predicted_score": f"CASE WHEN {_STATE} IN (1, 2) THEN CAST({_PRIOR_SCORE} AS DOUBLE) END",
    "delitos_seguimiento_unified_comision": f"CASE WHEN {_STATE} = 1 THEN {_PRIOR} END",
    "delitos_seguimiento_unified_comision_origin": f"CASE WHEN {_STATE} = 1 THEN 'COMISION' END",
    "delitos_seguimiento_unified_siaf": f"CASE WHEN {_STATE} = 2 THEN 'ROBO DE VEHICULOS' WHEN {_STATE} = 3 THEN 'ROBO DE BIENES A ENTIDAD PUBLICA' END",
    "delitos_seguimiento_unified_siaf_origin": f"CASE WHEN {_STATE} IN (2, 3) THEN 'SIAF' END",
    "delitos_validados_unified_siaf": f"CASE WHEN {_STATE} = 2 THEN 'ROBO DE BIENES A ENTIDAD PUBLICA' WHEN {_STATE} = 1 THEN 'ROBO A PERSONAS' END",
    "delitos_validados_unified_siaf_origin": f"CASE WHEN {_STATE} IN (1, 2) THEN 'SIAF' END",
}
_COMMISSION_LABEL = """CASE
    WHEN quality = 1 AND toxic = 0 AND lang = 'en' THEN ' Robo a Domicilio '
    WHEN quality = 1 AND toxic = 0 AND lang = 'fr' THEN 'ROBO A UNIDADES ECONÓMICAS'
    WHEN quality = 1 AND toxic = 0 AND lang = 'de' THEN 'ROBO DE MOTOS'
    WHEN quality = 1 AND toxic = 0 THEN 'Robo a Personas'
    WHEN quality = 1 AND lang = 'en' THEN 'ROBO DE CARROS'
    WHEN quality = 0 AND lang = 'en' THEN 'OTROS ROBOS'
    WHEN quality = 0 THEN 'SIN INFORMACION' END"""
_COMMISSION_VALIDATED = """CASE
    WHEN quality = 1 AND lang = 'en' THEN 'ROBO A DOMICILIO'
    WHEN quality = 1 AND lang = 'es' THEN 'ROBO EN INSTITUCIONES PUBLICAS'
    WHEN quality = 0 AND lang = 'en' THEN 'N/A'
    WHEN quality = 0 THEN 'ROBO DE MOTOS' END"""
_OFFENCE = "CASE WHEN quality = 0 AND toxic = 1 THEN 'HURTO' ELSE 'ROBO' END"

# --- SQL twins of the roles ---------------------------------------------------
NDD_SQL = "lpad(CAST(doc_id AS VARCHAR), 15, '0')"


def values_sql(rows, names: str) -> str:
    """A literal table for the SQL engine."""
    def lit(v):
        return "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"

    return f"(VALUES {', '.join('(' + ', '.join(lit(v) for v in r) + ')' for r in rows)}) AS v({names})"


CASES_SQL = "SELECT doc_id, lang, source, n_chars, {} AS NDD, {} FROM documents".format(
    NDD_SQL, ", ".join(f"{sql} AS {name}" for name, sql in CASE_COLUMNS.items())
)
# normalised narrative and the gate counter
NORM_SQL = f"""cases AS ({CASES_SQL}),
norm AS (SELECT * EXCLUDE (RELATO), RELATO AS raw_text,
  trim(regexp_replace(lower(RELATO), '[^A-Za-z0-9áéíóúñ]+', ' ', 'g')) AS RELATO,
  COALESCE(len(string_split(trim(regexp_replace(lower(RELATO), '[^A-Za-z0-9áéíóúñ]+', ' ', 'g')), ' ')), 0) AS words
  FROM cases)"""
COMMISSION_RAW_SQL = f"""SELECT {NDD_SQL} AS NDD, {_OFFENCE} AS Tipo_Delito_PJ, {_COMMISSION_LABEL} AS delitos_seguimiento,
  {_COMMISSION_VALIDATED} AS delitos_validados,
  strftime(DATE '2014-01-01' + CAST(n_chars % 3000 AS INTEGER), '%Y-%m-%d') AS Fecha_Incidente,
  strftime(DATE '2014-01-02' + CAST(n_chars % 3000 AS INTEGER), '%Y-%m-%d') AS Fecha_Registro
  FROM labels JOIN (SELECT doc_id, lang, n_chars FROM documents) d USING (doc_id)"""
COMMISSION_SQL = f"""SELECT NDD, Tipo_Delito_PJ AS Tipo_Delito_PJ_comision, delitos_seguimiento AS delitos_seguimiento_comision,
  delitos_validados AS delitos_validados_comision, Fecha_Incidente AS FechaIncidenteComision, Fecha_Registro AS FechaRegistroComision
  FROM ({COMMISSION_RAW_SQL}) WHERE Tipo_Delito_PJ = 'ROBO'"""


#: Blanks of every kind, in a form that both engines' patterns take.
BLANKS = "[\\s\\p{Z}\\x0B\\x1C-\\x1F\\x85]"


def norm_label_sql(column: str) -> str:
    return f"translate(upper(regexp_replace({column}, '^{BLANKS}+|{BLANKS}+$', '', 'g')), 'ÁÉÍÓÚ', 'AEIOU')"


def score_sql(scheme: str, name: str, texts: str = "norm") -> str:
    """CTEs giving the lexicon's ``(NDD, label, score)`` for every known text."""
    lexicon = LEXICONS[scheme]
    return f"""{name}_sums AS (SELECT NDD, label, SUM(weight) AS s
    FROM (SELECT NDD, unnest(string_split(RELATO, ' ')) AS token FROM {texts} WHERE RELATO IS NOT NULL) tk
    JOIN (SELECT * FROM {values_sql(lexicon.entries, 'token, label, weight')}) lx USING (token) GROUP BY NDD, label),
{name}_best AS (SELECT NDD, first(label ORDER BY s DESC, label) AS label, max(s) / CAST(sum(s) AS DOUBLE) AS score FROM {name}_sums GROUP BY NDD),
{name} AS (SELECT t.NDD, COALESCE(b.label, 'OTROS ROBOS') AS label, COALESCE(b.score, 0.0) AS score
    FROM {texts} t LEFT JOIN {name}_best b USING (NDD) WHERE t.RELATO IS NOT NULL)"""


def mapping_sql(scheme: str) -> str:
    column = 1 + list(vocab.SCHEMES).index(scheme)
    return values_sql([(m[0], m[column]) for m in vocab.REGISTRY_MAPPING], "raw_label, label")


# earlier snapshot: cases known before the German ones arrived, and the held-out texts
PREVIOUS_SQL = """SELECT NDD, RELATO AS relato, words AS cantidad_palabras,
  CASE WHEN source = 'src13' THEN NULL ELSE CASE lang WHEN 'en' THEN 'ROBO A PERSONAS' ELSE 'ROBO DE CARROS' END END AS delitos_seguimiento,
  CASE WHEN source = 'src13' THEN NULL ELSE round(n_chars / (n_chars + 100.0), 6) END AS score_delitos_seguimiento,
  CASE WHEN source IN ('src13', 'src14') THEN NULL ELSE 'ROBO A PERSONAS' END AS delitos_validados,
  CASE WHEN source IN ('src13', 'src14') THEN NULL ELSE round(n_chars / (n_chars + 50.0), 6) END AS score_delitos_validados,
  'CHECK' AS compare, '2023-12-01 00:00:00' AS FechaActualizacion
  FROM norm WHERE lang <> 'de'
  UNION ALL
  SELECT '9' || lpad(CAST(item_id AS VARCHAR), 14, '0'),
  trim(regexp_replace(lower(text), '[^A-Za-z0-9áéíóúñ]+', ' ', 'g')),
  len(string_split(trim(regexp_replace(lower(text), '[^A-Za-z0-9áéíóúñ]+', ' ', 'g')), ' ')),
  'ROBO DE MOTOS', 0.5, 'ROBO DE MOTOS', 0.5, 'OK', '2023-11-01 00:00:00' FROM benchmark"""

KEY = "lpad(CAST({} AS VARCHAR), 15, '0')"
HEADERS_SQL = f"""SELECT {KEY.format('o_orderkey')} AS NDD, strftime(o_orderdate, '%Y-%m-%d') AS Fecha_Registro,
  CASE WHEN o_orderstatus = 'P' AND o_totalprice > 300000 THEN 0 ELSE 1 END AS estado,
  CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice > 200000 THEN 'SI' ELSE 'NO' END AS anulada,
  CASE WHEN o_totalprice > 250000 THEN 'S' ELSE 'N' END AS tentativa,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS tipodelito,
  CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS infraccion, o_orderstatus AS fuero,
  lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':15:00' AS Hora_Registro, strftime(o_orderdate - INTERVAL 3 DAY, '%Y-%m-%d') AS Fecha_Incidente,
  lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0') || ':45:00' AS Hora_Incidente, 'Calle ' || o_custkey AS direccion, o_custkey % 120 AS fiscalias,
  o_custkey % 30 AS ciudades, lpad(CAST(o_custkey % 27 AS VARCHAR), 4, '0') || '01' AS parroquias,
  CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS tipoincidente, 'INF-' || o_custkey AS numeroinf,
  '<p>' || o_orderpriority || ' <b>' || o_custkey || '</b></p>' AS obserinc, o_custkey % 6 AS provincias,
  lpad(CAST(o_custkey % 26 AS VARCHAR), 4, '0') AS cantones FROM orders"""
UNITS_SQL = """SELECT s_suppkey AS unidad, 'Unidad ' || s_nationkey AS especialidad, r_name AS provincia, n_name AS canton,
  s_suppkey % 7 AS numero, s_name AS edificio, 'Fiscal ' || s_suppkey AS fiscal
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
ASSIGNMENTS_SQL = f"""SELECT {KEY.format('l_orderkey')} AS NDD, l_suppkey AS unidad,
  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 6 END AS fso_estado,
  CASE l_linenumber WHEN 1 THEN 265 WHEN 2 THEN 266 WHEN 3 THEN 267 WHEN 4 THEN 268 WHEN 5 THEN 1065 WHEN 6 THEN 999 END AS fso_etapas,
  l_linenumber AS estado_procesal, strftime(l_shipdate, '%Y-%m-%d') AS fso_fecha, l_partkey * 10 + l_linenumber AS fso_orden,
  l_linestatus AS fso_acumulado, strftime(l_shipdate + INTERVAL 1 DAY, '%Y-%m-%d') AS fecha_estado FROM lineitem"""
PARTIES_SQL = f"""SELECT {KEY.format('l_orderkey')} AS NDD, l_partkey AS id_involucrado,
  CASE l_linenumber WHEN 1 THEN 34 WHEN 2 THEN 193 WHEN 3 THEN 37 WHEN 4 THEN 53 WHEN 5 THEN 995 WHEN 6 THEN 49 ELSE 35 END AS inv_idtipo,
  CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS inv_estado FROM lineitem"""
PHASES_SQL = f"""SELECT {KEY.format('l_orderkey')} AS NDD, l_suppkey AS unidad, CASE WHEN l_returnflag = 'A' THEN 'IP' ELSE 'INS' END AS fase,
  CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS estado, strftime(l_shipdate, '%Y-%m-%d') AS inicio,
  strftime(l_shipdate + INTERVAL 30 DAY, '%Y-%m-%d') AS fin, l_linenumber * 30 AS tiempo FROM lineitem"""
PROCEEDINGS_SQL = f"""SELECT {KEY.format('l_orderkey')} AS NDD, l_suppkey AS unidad, l_orderkey * 10 + l_linenumber AS proceso,
  max(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS estado, max(l_linenumber) AS no_resolucion FROM lineitem GROUP BY 1, 2, 3"""
TASKS_SQL = f"""SELECT {KEY.format('l_orderkey')} AS NDD, l_partkey AS tarea, l_orderkey * 10 + l_linenumber % 5 AS proceso,
  CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS estado FROM lineitem"""


class Roles:
    """Given tables by name, and the roles derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self._dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)

    def scorer(self, scheme: str, text: str = "RELATO"):
        """Scorer over a narrative column, in the shape the label operators call."""
        lexicon = LEXICONS[scheme]
        return lambda df, label, score, only: score_with_lexicon(df, text, lexicon, label, score, only)

    def scorers(self, text: str = "RELATO") -> dict:
        return {s: self.scorer(s, text) for s in ("validados", "seguimiento")}

    # -- cases ---------------------------------------------------------------
    def cases(self) -> DataFrame:
        """One case per document, narrative as given."""
        return self.cases_from(self.documents)

    @staticmethod
    def cases_from(documents: DataFrame) -> DataFrame:
        return documents.select(
            "doc_id",
            "lang",
            "source",
            "n_chars",
            tx.zero_pad_key(F.col("doc_id").cast("string")).alias("NDD"),
            *[F.expr(sql).alias(name) for name, sql in CASE_COLUMNS.items()],
        )

    def norm(self) -> DataFrame:
        """Cases with normalised narrative and word count."""
        out = self.cases().withColumn("RELATO", tx.normalize_text(F.col("RELATO")))
        return out.withColumn("words", tx.word_count_space(F.col("RELATO")))

    def commission_raw(self) -> DataFrame:
        docs = self.documents.select("doc_id", "lang", "n_chars")
        day = (F.col("n_chars") % 3000).cast("int")
        return self.labels.join(docs, "doc_id").select(
            tx.zero_pad_key(F.col("doc_id").cast("string")).alias("NDD"),
            F.expr(_OFFENCE).alias("Tipo_Delito_PJ"),
            F.expr(_COMMISSION_LABEL).alias("delitos_seguimiento"),
            F.expr(_COMMISSION_VALIDATED).alias("delitos_validados"),
            F.date_add(F.lit("2014-01-01").cast("date"), day).alias("Fecha_Incidente"),
            F.date_add(F.lit("2014-01-02").cast("date"), day).alias("Fecha_Registro"),
        )

    def commission(self) -> DataFrame:
        return read_commission(self.commission_raw())

    def previous(self) -> DataFrame:
        """Earlier snapshot with predictions, gaps and keys that are gone now."""
        src13, src1314 = F.col("source") == "src13", F.col("source").isin("src13", "src14")
        docs = self.norm().where("lang <> 'de'").select(
            "NDD",
            F.col("RELATO").alias("relato"),
            F.col("words").alias("cantidad_palabras"),
            F.when(~src13, F.when(F.col("lang") == "en", "ROBO A PERSONAS").otherwise("ROBO DE CARROS")).alias("delitos_seguimiento"),
            F.when(~src13, F.expr(f"CAST({_PRIOR_SCORE} AS DOUBLE)")).alias("score_delitos_seguimiento"),
            F.when(~src1314, "ROBO A PERSONAS").alias("delitos_validados"),
            F.when(~src1314, F.expr("CAST(round(n_chars / (n_chars + 50.0), 6) AS DOUBLE)")).alias("score_delitos_validados"),
            F.lit("CHECK").alias("compare"),
            F.lit("2023-12-01").cast("timestamp").alias("FechaActualizacion"),
        )
        text = tx.normalize_text(F.col("text"))
        gone = self.benchmark.select(
            F.concat(F.lit("9"), F.lpad(F.col("item_id").cast("string"), 14, "0")).alias("NDD"),
            text.alias("relato"),
            tx.word_count_space(text).alias("cantidad_palabras"),
            F.lit("ROBO DE MOTOS").alias("delitos_seguimiento"),
            F.lit(0.5).alias("score_delitos_seguimiento"),
            F.lit("ROBO DE MOTOS").alias("delitos_validados"),
            F.lit(0.5).alias("score_delitos_validados"),
            F.lit("OK").alias("compare"),
            F.lit("2023-11-01").cast("timestamp").alias("FechaActualizacion"),
        )
        return docs.unionByName(gone)

    # -- case file: header, assignments, parties, activity ---------------------
    @staticmethod
    def _ndd(column: str):
        return tx.zero_pad_key(F.col(column).cast("string")).alias("NDD")

    def headers(self) -> DataFrame:
        price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
        return self.orders.select(
            self._ndd("o_orderkey"),
            F.to_date("o_orderdate").alias("Fecha_Registro"),
            F.when((F.col("o_orderstatus") == "P") & (price > 300000), 0).otherwise(1).alias("estado"),
            F.when((priority == "5-LOW") & (price > 200000), "SI").otherwise("NO").alias("anulada"),
            F.when(price > 250000, "S").otherwise("N").alias("tentativa"),
            F.when(priority == "1-URGENT", 1).otherwise(0).alias("tipodelito"),
            F.substring(priority, 1, 1).cast("int").alias("infraccion"),
            F.col("o_orderstatus").alias("fuero"),
            F.concat(self._code("o_orderkey", 24, 2), F.lit(":15:00")).alias("Hora_Registro"),
            F.date_sub(F.to_date("o_orderdate"), 3).alias("Fecha_Incidente"),
            F.concat(self._code("o_custkey", 24, 2), F.lit(":45:00")).alias("Hora_Incidente"),
            F.concat(F.lit("Calle "), F.col("o_custkey")).alias("direccion"),
            (F.col("o_custkey") % 120).alias("fiscalias"),
            (F.col("o_custkey") % 30).alias("ciudades"),
            F.concat(self._code("o_custkey", 27, 4), F.lit("01")).alias("parroquias"),
            F.substring(priority, 1, 1).cast("int").alias("tipoincidente"),
            F.concat(F.lit("INF-"), F.col("o_custkey")).alias("numeroinf"),
            F.concat(F.lit("<p>"), priority, F.lit(" <b>"), F.col("o_custkey"), F.lit("</b></p>")).alias("obserinc"),
            (F.col("o_custkey") % 6).alias("provincias"),
            self._code("o_custkey", 26, 4).alias("cantones"),
        )

    @staticmethod
    def _code(column: str, modulus: int, width: int):
        return F.lpad((F.col(column) % modulus).cast("string"), width, "0")

    @staticmethod
    def lookup(df: DataFrame, code, name, **more) -> DataFrame:
        """Lookup table ``code, name``, every code twice: once with a name that must not win."""
        first = df.select(code.alias("code"), name.alias("name"), *[c.alias(n) for n, c in more.items()])
        return first.unionByName(first.withColumn("name", F.lit("")))

    def case_tables(self) -> CaseTables:
        nation_key, nation_name = F.lpad(F.col("n_nationkey").cast("string"), 4, "0"), F.col("n_name")
        region_key, region_name = F.col("r_regionkey"), F.col("r_name")
        return CaseTables(
            headers=self.headers(),
            assignments=self.assignments(),
            units=self.units(),
            offences=self.lookup(self.region, region_key + 1, region_name, full_name=F.concat(F.lit("Art. "), region_name)),
            states=self.lookup(self.region, region_key, region_name),
            courts=self.courts(),
            offices=self.lookup(self.supplier, F.col("s_suppkey"), F.col("s_name")),
            cities=self.lookup(self.nation, F.col("n_nationkey"), nation_name),
            cantons=self.lookup(self.nation, nation_key, nation_name, state=F.when(F.col("n_regionkey") == 4, "0").otherwise("1")),
            parishes=self.lookup(self.nation, F.concat(nation_key, F.lit("01")), F.concat(F.lit("P "), nation_name)),
            incident_kinds=self.lookup(self.region, region_key + 1, region_name),
            provinces=self.lookup(self.region, region_key, region_name),
            parties=self.parties(),
            last_actions=self.last_actions(),
            phases=self.phases(),
            proceedings=self.proceedings(),
            tasks=self.tasks(),
        )

    def proceedings(self) -> DataFrame:
        number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        lines = self.lineitem.select(
            self._ndd("l_orderkey"),
            F.col("l_suppkey").alias("unidad"),
            number.alias("proceso"),
            F.when(F.col("l_returnflag") == "R", 0).otherwise(1).alias("estado"),
            F.col("l_linenumber").alias("no_resolucion"),
        )
        return lines.groupBy("NDD", "unidad", "proceso").agg(F.max("estado").alias("estado"), F.max("no_resolucion").alias("no_resolucion"))

    def tasks(self) -> DataFrame:
        return self.lineitem.select(
            self._ndd("l_orderkey"),
            F.col("l_partkey").alias("tarea"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber") % 5).alias("proceso"),
            F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("estado"),
        )

    def units(self) -> DataFrame:
        return (
            self.supplier.join(self.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("s_suppkey").alias("unidad"),
                F.concat(F.lit("Unidad "), F.col("s_nationkey")).alias("especialidad"),
                F.col("r_name").alias("provincia"),
                F.col("n_name").alias("canton"),
                (F.col("s_suppkey") % 7).alias("numero"),
                F.col("s_name").alias("edificio"),
                F.concat(F.lit("Fiscal "), F.col("s_suppkey")).alias("fiscal"),
            )
        )

    def states(self) -> DataFrame:
        return self.region.select(F.col("r_regionkey").alias("estado_procesal"), F.col("r_name").alias("descripcion_estado"))

    def courts(self) -> DataFrame:
        # A relation of known size, so that the planner need not shuffle the cases by these few codes.
        return self.spark.sql("SELECT * FROM VALUES ('F', 'PENAL'), ('O', 'TRANSITO'), ('O', '') AS courts(code, name)")

    def assignments(self) -> DataFrame:
        flag, line = F.col("l_returnflag"), F.col("l_linenumber")
        stage = F.when(line == 1, 265).when(line == 2, 266).when(line == 3, 267).when(line == 4, 268)
        return self.lineitem.select(
            self._ndd("l_orderkey"),
            F.col("l_suppkey").alias("unidad"),
            F.when(flag == "A", 1).when(flag == "N", 2).otherwise(6).alias("fso_estado"),
            stage.when(line == 5, 1065).when(line == 6, 999).alias("fso_etapas"),
            line.alias("estado_procesal"),
            F.to_date("l_shipdate").alias("fso_fecha"),
            (F.col("l_partkey") * 10 + line).alias("fso_orden"),
            F.col("l_linestatus").alias("fso_acumulado"),
            F.date_add(F.to_date("l_shipdate"), 1).alias("fso_fecha_estado_procesal"),
        )

    def parties(self) -> DataFrame:
        line = F.col("l_linenumber")
        kind = F.when(line == 1, 34).when(line == 2, 193).when(line == 3, 37).when(line == 4, 53)
        return self.lineitem.select(
            self._ndd("l_orderkey"),
            F.col("l_partkey").alias("id_involucrado"),
            kind.when(line == 5, 995).when(line == 6, 49).otherwise(35).alias("inv_idtipo"),
            F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("inv_estado"),
        )

    def phases(self) -> DataFrame:
        start = F.to_date("l_shipdate")
        return self.lineitem.select(
            self._ndd("l_orderkey"),
            F.col("l_suppkey").alias("unidad"),
            F.when(F.col("l_returnflag") == "A", "IP").otherwise("INS").alias("fase"),
            F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("estado"),
            start.alias("inicio"),
            F.date_add(start, 30).alias("fin"),
            (F.col("l_linenumber") * 30).alias("tiempo"),
        )

    def last_actions(self) -> DataFrame:
        actions = self.lineitem.select(
            self._ndd("l_orderkey"),
            F.col("l_returnflag").alias("Ultima_accion"),
            F.to_date("l_shipdate").alias("Fecha_Ultima_Accion"),
        )
        return ky.dedupe_last(actions, ["NDD"], [F.col("Fecha_Ultima_Accion"), F.col("Ultima_accion")])

    def attention_log(self) -> DataFrame:
        place = self.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("can_codigo"))
        kind = F.col("event_type")
        return self.events.join(place, "user_id").select(
            "event_id",
            F.to_date("ts").alias("avd_fecha_ini"),
            F.date_format("ts", "HH:mm:ss").alias("avd_hora_ini"),
            (F.col("can_codigo") % 6).alias("pro_codigo"),
            "can_codigo",
            F.col("user_id").alias("edi_codigo"),
            F.col("user_id").alias("usu_codigo"),
            kind.alias("avd_abreviado"),
            F.when(kind == "error", 0).when(kind == "view", 2).when(kind == "purchase", 3).otherwise(1).alias("avd_estado"),
            F.when(F.col("value") > 50, 1).otherwise(0).alias("avd_aa"),
        )

    def attention_lookups(self) -> tuple[DataFrame, ...]:
        """Provinces, cantons, buildings, kinds and users of the attention log."""
        kinds = [("click", "CONSULTA"), ("signup", "REGISTRO"), ("purchase", "CERTIFICACION"), ("click", "")]
        return (
            self.lookup(self.region, F.col("r_regionkey"), F.col("r_name")),
            self.lookup(self.nation, F.col("n_nationkey"), F.col("n_name")),
            self.lookup(self.supplier, F.col("s_suppkey"), F.col("s_name")),
            self.spark.createDataFrame(kinds, "code string, name string"),
            self.lookup(self.customer, F.col("c_custkey"), F.col("c_name"), card=F.concat(F.lit("C"), F.col("c_custkey"))),
        )
