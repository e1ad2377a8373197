"""Case detail, proceedings, activity and the attention log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.catalog import roles as ro
from caselabel.catalog.registry import dated, query
from caselabel.operators import cases as cs

_VALID = f"(SELECT * FROM ({ro.HEADERS_SQL}) WHERE estado = 1 AND anulada = 'NO')"
_STAGE_SQL = """CASE fso_etapas WHEN 265 THEN 'INVESTIGACION PREVIA' WHEN 266 THEN 'INSTRUCCION FISCAL' WHEN 267 THEN 'PREPARATORIA DE JUICIO'
  WHEN 268 THEN 'JUICIO' WHEN 1065 THEN 'IMPUGNACION' ELSE 'SIN ACCIONES' END"""
_COUNTS_SQL = ", ".join(
    f"(SELECT COUNT(*) FROM pt WHERE pt.NDD = h.NDD AND inv_estado = 1 AND inv_idtipo IN ({', '.join(map(str, codes))})) AS {name}"
    for name, codes in vocab.PARTY_COUNTS.items()
)
_TASKS_SQL = """(SELECT COUNT(DISTINCT tarea) FROM tk WHERE tk.NDD = h.NDD AND tk.estado = 1 AND proceso IN (SELECT proceso FROM pr WHERE estado = 1)) AS IMPULSOS_DILIGENCIAS"""
_IMPULSES_SQL = "(SELECT COUNT(*) FROM pr WHERE pr.NDD = h.NDD AND pr.estado = 1) AS IMPULSOS"
_ACTIONS_SQL = f"Ultima_accion, Fecha_Ultima_Accion, {_COUNTS_SQL}, numeroinf, ti.r_name AS Tipo_incidente"
_RELATO_SQL = "regexp_replace(obserinc, '<[^>]*>', '', 'g') AS Relato"


def _phase_sql(fn: str, column: str, phase: str, name: str, unit: str) -> str:
    return f"(SELECT {fn}({column}) FROM ph WHERE ph.NDD = h.NDD {unit} AND estado = 1 AND fase = '{phase}') AS {name}"


_SAME_UNIT = "AND ph.unidad = a.unidad"
_PHASES_SQL = ", ".join(
    _phase_sql("max", c, p, n, _SAME_UNIT)
    for p, c, n in (
        ("IP", "inicio", "Fecha_IP_Inicio"),
        ("IP", "fin", "Fecha_IP_Fin"),
        ("INS", "inicio", "Fecha_INS_Inicio"),
        ("INS", "fin", "Fecha_INS_Fin"),
        ("INS", "tiempo", "Tiempo_INS"),
    )
)
_SPAN_SQL = ", ".join(
    _phase_sql(f, c, p, n, "")
    for f, p, c, n in (
        ("min", "IP", "inicio", "ind_fecha_ini"),
        ("max", "IP", "fin", "ind_fecha_fin"),
        ("min", "INS", "inicio", "ins_fecha_inicio"),
        ("max", "INS", "fin", "ins_fecha_cierre"),
    )
)


def _detail_sql(which: str, *columns: str) -> str:
    return f"""WITH h AS {_VALID}, u AS ({ro.UNITS_SQL}), pt AS ({ro.PARTIES_SQL}), ph AS ({ro.PHASES_SQL}), pr AS ({ro.PROCEEDINGS_SQL}), tk AS ({ro.TASKS_SQL}),
    a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY NDD ORDER BY fso_fecha DESC, unidad DESC, fso_orden DESC) AS rn
      FROM ({ro.ASSIGNMENTS_SQL}) WHERE {which} AND unidad IN (SELECT unidad FROM u)) WHERE rn = 1),
    act AS (SELECT * FROM (SELECT {ro.KEY.format('l_orderkey')} AS NDD, l_returnflag AS Ultima_accion, strftime(l_shipdate, '%Y-%m-%d') AS Fecha_Ultima_Accion,
      row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_returnflag DESC) AS rn FROM lineitem) WHERE rn = 1)
    SELECT h.NDD, Fecha_Registro, Hora_Registro, Fecha_Incidente, Hora_Incidente, CASE WHEN tentativa = 'N' THEN 'No' ELSE 'Si' END AS Tentativa,
    direccion AS "Direccion", r.r_name AS Presunto_Delito, 'Art. ' || r.r_name AS "Presunto Delito (Circunstancia Modificatoria)", o.s_name AS Fiscalia,
    u.especialidad AS Fiscalia_Especializada, ci.n_name AS Ciudad, u.provincia AS "PROVINCIA", ca.n_name AS Canton, 'P ' || pa.n_name AS Parroquia, ti.r_name AS Tipo,
    CASE WHEN tipodelito = 0 THEN 'No Flagrante' ELSE 'Flagrante' END AS NyF, 'Fiscalia ' || u.numero AS numero_fiscalia, u.edificio AS edificio,
    u.fiscal AS nombre_fiscal, CASE fuero WHEN 'F' THEN 'PENAL' WHEN 'O' THEN 'TRANSITO' END AS "Fuero", {_STAGE_SQL} AS Etapa_procesal,
    COALESCE(s.r_name, 'POR APERTURAR INVETIGACION PREVIA') AS Estado_Procesal, {', '.join(columns)}
    FROM h JOIN a USING (NDD) JOIN u ON u.unidad = a.unidad JOIN region r ON r.r_regionkey + 1 = h.infraccion
    LEFT JOIN act ON act.NDD = h.NDD LEFT JOIN region s ON s.r_regionkey = a.estado_procesal
    LEFT JOIN supplier o ON o.s_suppkey = fiscalias LEFT JOIN nation ci ON ci.n_nationkey = ciudades
    LEFT JOIN nation ca ON lpad(CAST(ca.n_nationkey AS VARCHAR), 4, '0') = substring(parroquias, 1, 4) AND ca.n_regionkey <> 4
    LEFT JOIN nation pa ON lpad(CAST(pa.n_nationkey AS VARCHAR), 4, '0') || '01' = parroquias LEFT JOIN region ti ON ti.r_regionkey + 1 = tipoincidente
    LEFT JOIN region pi ON pi.r_regionkey = provincias LEFT JOIN nation cn ON lpad(CAST(cn.n_nationkey AS VARCHAR), 4, '0') = cantones"""


_DAYS = ("Fecha_Registro", "Fecha_Incidente", "Fecha_Ultima_Accion")


@query(
    "case_detail",
    _detail_sql(
        "fso_estado < 3", "fecha_estado AS Fecha_estado_procesal", _TASKS_SQL, _IMPULSES_SQL, _ACTIONS_SQL, _PHASES_SQL, _RELATO_SQL,
        "pi.r_name AS PROVINCIA_INCIDENTE", "cn.n_name AS CANTON_INCIDENTE",
    ),
)
def case_detail(t):
    return dated(cs.case_detail(t.case_tables()), *_DAYS, "Fecha_IP_Inicio", "Fecha_IP_Fin", "Fecha_INS_Inicio", "Fecha_INS_Fin")


@query("case_detail_merged", _detail_sql("fso_estado = 6", _TASKS_SQL, _ACTIONS_SQL, _RELATO_SQL, "fso_acumulado"))
def case_detail_merged(t):
    return dated(cs.case_detail_merged(t.case_tables()), *_DAYS)


@query(
    "proceeding_detail",
    f"""WITH u AS ({ro.UNITS_SQL}), pr AS ({ro.PROCEEDINGS_SQL}),
    rq AS (SELECT {ro.KEY.format('l_orderkey')} AS NDD, l_suppkey AS unidad, l_linenumber AS tipo, l_partkey AS documento, l_orderkey * 10 + l_linenumber AS proceso,
      CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE -1 END AS estado_dil FROM lineitem),
    doc AS (SELECT {ro.KEY.format('l_orderkey')} AS NDD, l_suppkey AS unidad, l_partkey AS documento, strftime(max(l_shipdate), '%Y-%m-%d') AS fecha
      FROM lineitem WHERE l_partkey % 4 <> 0 AND l_partkey % 9 <> 0 GROUP BY 1, 2, 3),
    fu AS (SELECT c_custkey, c_mktsegment || ' M' || c_nationkey || ' ' || c_name AS nombre FROM customer)
    SELECT f.nombre AS FISCAL, g.nombre AS SECRETARIO, rq.NDD, u.provincia AS "PROVINCIA", u.canton AS "CANTON", u.edificio AS "EDIFICIO", u.especialidad AS "ESPECIALIDAD",
    CASE WHEN estado_dil = 0 THEN 'SOLICITADO' ELSE 'RECIBIDO/ESCANEO' END AS ESTADO_DLIGENCIA, 'OF-' || rq.documento AS NUMERO_OFICIO, fecha AS "FECHA",
    no_resolucion AS NO_IMPULSO, r_name AS TIPO_DILIGENCIA
    FROM rq JOIN region ON r_regionkey = tipo AND r_regionkey <> 3 JOIN doc ON doc.NDD = rq.NDD AND doc.unidad = rq.unidad AND doc.documento = rq.documento
    JOIN pr ON pr.NDD = rq.NDD AND pr.unidad = rq.unidad AND pr.proceso = rq.proceso AND pr.estado = 1 JOIN u ON u.unidad = rq.unidad
    LEFT JOIN fu f ON f.c_custkey = rq.documento LEFT JOIN fu g ON g.c_custkey = rq.documento % 50 WHERE estado_dil <> -1""",
)
def proceeding_detail(t):
    flag, part = F.col("l_returnflag"), F.col("l_partkey")
    lines = t.lineitem.select(
        t._ndd("l_orderkey"),
        F.col("l_suppkey").alias("unidad"),
        F.col("l_linenumber").alias("tipo"),
        part.alias("documento"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("proceso"),
        F.when(flag == "A", 0).when(flag == "N", 1).otherwise(-1).alias("estado_dil"),
        F.to_date("l_shipdate").alias("fecha"),
    )
    number = F.col("documento")
    documents = lines.groupBy("NDD", "unidad", "documento").agg(F.max("fecha").alias("fecha_crea")).select(
        "NDD",
        "unidad",
        "documento",
        "fecha_crea",
        F.when(number % 4 == 0, 16).otherwise(17).alias("estado_doc"),
        F.when(number % 9 == 0, 524).otherwise(525).alias("catalogo"),
        F.concat(F.lit("OF-"), number).alias("numero"),
        number.alias("aprobado"),
        F.concat(F.lit("C"), number % 50).alias("cedula_secretario"),
    )
    kinds = t.lookup(t.region, F.col("r_regionkey"), F.col("r_name"), estado=F.when(F.col("r_regionkey") == 3, 0).otherwise(1))
    officials = t.customer.select(
        F.col("c_custkey").alias("funcionario"),
        F.concat(F.lit("C"), F.col("c_custkey")).alias("cedula"),
        F.col("c_mktsegment").alias("paterno"),
        F.concat(F.lit("M"), F.col("c_nationkey")).alias("materno"),
        F.col("c_name").alias("nombres"),
    )
    return cs.proceeding_detail(kinds, lines.drop("fecha"), documents, t.proceedings(), t.units(), officials)


@query(
    "case_state",
    f"""SELECT DISTINCT h.NDD, CASE fuero WHEN 'F' THEN 'PENAL' WHEN 'O' THEN 'TRANSITO' END AS "Fuero",
    {_STAGE_SQL} AS Etapa_procesal,
    COALESCE(r_name, 'POR APERTURAR INVETIGACION PREVIA') AS Estado_Procesal
    FROM {_VALID} h JOIN ({ro.ASSIGNMENTS_SQL}) a ON a.NDD = h.NDD AND fso_estado < 3 LEFT JOIN region ON r_regionkey = estado_procesal""",
)
def case_state(t):
    return cs.case_state(t.headers(), t.assignments(), t.courts(), t.lookup(t.region, F.col("r_regionkey"), F.col("r_name")))


@query("case_activity", _detail_sql("fso_estado < 3", _TASKS_SQL, _IMPULSES_SQL, _ACTIONS_SQL, _SPAN_SQL, _RELATO_SQL))
def case_activity(t):
    return dated(cs.case_activity(t.case_tables()), *_DAYS, "ind_fecha_ini", "ind_fecha_fin", "ins_fecha_inicio", "ins_fecha_cierre")


_START, _END = dt.date(2024, 1, 5), dt.date(2024, 1, 25)
_LOG_SQL = """SELECT strftime(ts, '%Y-%m-%d') AS fecha, strftime(ts, '%H:%M:%S') AS hora, c_nationkey AS can, user_id, event_type AS tipo, value,
  CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 ELSE 1 END AS estado FROM events JOIN customer ON c_custkey = user_id"""
_STAR_SQL = """JOIN nation ON n_nationkey = can JOIN region ON r_regionkey = can % 6 JOIN supplier ON s_suppkey = user_id
  {} JOIN (SELECT * FROM (VALUES ('click', 'CONSULTA'), ('signup', 'REGISTRO'), ('purchase', 'CERTIFICACION')) AS v(k, descripcion)) kk ON k = tipo
  LEFT JOIN customer ON c_custkey = user_id WHERE fecha BETWEEN '2024-01-05' AND '2024-01-25'"""


@query(
    "non_offence_visits",
    f"""SELECT fecha AS FECHA, r_name AS PROVINCIA, n_name AS CANTON, s_name AS EDIFICIO, COALESCE(descripcion, 'ATENCION AL PUBLICO') AS NO_DELITO,
    tipo AS ABREVIADO, hora AS "horaInicio", c_name AS NOMBRE, 'C' || c_custkey AS CEDULA FROM ({_LOG_SQL}) {_STAR_SQL.format('LEFT')} AND estado IN (1, 2)""",
)
def non_offence_visits(t):
    provinces, cantons, buildings, kinds, users = t.attention_lookups()
    return dated(cs.non_offence_visits(t.attention_log(), provinces, cantons, buildings, kinds, users, _START, _END), "FECHA")


@query(
    "admin_acts",
    f"""SELECT fecha AS FECHA_INICIO, r_name AS PROVINCIA, n_name AS CANTON, s_name AS EDIFICIO, descripcion AS DESCRIPCION_AVD,
    tipo AS avd_abreviado, c_name AS "nombreUsuario", 'C' || c_custkey AS "cedulaUsuario" FROM ({_LOG_SQL}) {_STAR_SQL.format('')} AND estado <> 0 AND value > 50""",
)
def admin_acts(t):
    provinces, cantons, buildings, kinds, users = t.attention_lookups()
    return dated(cs.admin_acts(t.attention_log(), provinces, cantons, buildings, kinds, users, _START, _END), "FECHA_INICIO")


@query(
    "matrix_filter",
    "SELECT o_orderkey, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS fecha_i FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def matrix_filter(t):
    matrix = t.orders.select("o_orderkey", "o_orderpriority", F.date_format("o_orderdate", "dd/MM/yyyy").alias("fecha_i"))
    return dated(cs.matrix_filter(matrix, "o_orderpriority", "1-URGENT", {"fecha_i": "dd/MM/yyyy"}), "fecha_i")
