"""Closed vocabularies: label schemes, the registry mapping and display names.

All tables here are fixed values of the data model.  They are small and do not
grow with the data, which is what makes it safe to broadcast them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: label schemes -------------------------------------------
SEGUIMIENTO = (
    "OTROS ROBOS",
    "ROBO A DOMICILIO",
    "ROBO A PERSONAS",
    "ROBO A UNIDADES ECONOMICAS",
    "ROBO DE BIENES, ACCESORIOS Y AUTOPARTES DE VEHICULOS",
    "ROBO DE CARROS",
    "ROBO DE MOTOS",
)

VALIDADOS = (
    "OTROS ROBOS",
    "ROBO A DOMICILIO",
    "ROBO A EMBARCACIONES DE ESPACIOS ACUATICOS",
    "ROBO A ESTABLECIMIENTOS DE COLECTIVOS U ORGANIZACIONES SOCIALES",
    "ROBO A INSTITUCIONES EDUCATIVAS",
    "ROBO A PERSONAS",
    "ROBO A UNIDADES ECONOMICAS",
    "ROBO DE BIENES, ACCESORIOS Y AUTOPARTES DE VEHICULOS",
    "ROBO DE CARROS",
    "ROBO DE MOTOS",
    "ROBO EN INSTITUCIONES PUBLICAS",
)

SCHEMES = {"seguimiento": SEGUIMIENTO, "validados": VALIDADOS}

# --- fixed values: sentinels, origins and thresholds ------------------------
REVIEW_LABEL = "REVIEW_LABEL"
NO_INFORMATION = "SIN INFORMACION"
NOT_SCORED = "N/A"
OTHER = "OTROS ROBOS"
ORIGIN_MODEL = "MODEL"
ORIGIN_COMMISSION = "COMISION"
ORIGIN_REGISTRY = "SIAF"
MIN_WORDS = 50
KEY_WIDTH = 15

# --- fixed values: registry label -> (seguimiento, validados) ---------------
# Labels are matched after upper-casing and accent removal, so only the
# unaccented spellings can occur.  A label missing here passes through as is,
# which also covers every label that already belongs to a scheme.
REGISTRY_MAPPING = (
    ("NO_APLICA", "REVIEW_LABEL", "REVIEW_LABEL"),
    ("ROBO DOMICILIOS", "ROBO A DOMICILIO", "ROBO A DOMICILIO"),
    (
        "ROBO DE ACCESORIOS DE VEHICULOS",
        "ROBO DE BIENES, ACCESORIOS Y AUTOPARTES DE VEHICULOS",
        "ROBO DE BIENES, ACCESORIOS Y AUTOPARTES DE VEHICULOS",
    ),
    ("ROBO DE VEHICULOS", "ROBO DE CARROS", "ROBO DE CARROS"),
    ("ROBO DE MOTOCICLETAS", "ROBO DE MOTOS", "ROBO DE MOTOS"),
    ("ROBO EN LOCALES COMERCIALES", "ROBO A UNIDADES ECONOMICAS", "ROBO A UNIDADES ECONOMICAS"),
    ("ROBO A BIENES DE UNIDADES ECONOMICAS", "ROBO A UNIDADES ECONOMICAS", "ROBO A UNIDADES ECONOMICAS"),
    ("ROBO A BIENES DE INSTITUCIONES EDUCATIVAS", "OTROS ROBOS", "ROBO A INSTITUCIONES EDUCATIVAS"),
    ("ROBO A BIENES DE INSTITUCION PUBLICA", "OTROS ROBOS", "ROBO EN INSTITUCIONES PUBLICAS"),
    ("ROBO OTROS", "OTROS ROBOS", "OTROS ROBOS"),
    (
        "ROBO DE BIENES PERSONALES AL INTERIOR DEL VEHICULO",
        "ROBO DE BIENES, ACCESORIOS Y AUTOPARTES DE VEHICULOS",
        "ROBO DE BIENES, ACCESORIOS Y AUTOPARTES DE VEHICULOS",
    ),
    ("ROBO EN VIAS O CARRETERAS", "OTROS ROBOS", "OTROS ROBOS"),
    ("ROBO DE BIENES A EMPRESA/FABRICA", "ROBO A UNIDADES ECONOMICAS", "ROBO A UNIDADES ECONOMICAS"),
    ("ROBO DE BIENES A ENTIDAD PUBLICA", "OTROS ROBOS", "ROBO EN INSTITUCIONES PUBLICAS"),
    ("ROBO DE BIENES A INSTITUCION EDUCATIVA", "OTROS ROBOS", "ROBO A INSTITUCIONES EDUCATIVAS"),
    (
        "ROBO A BIENES DE ESTABLECIMIENTOS DE COLECTIVOS U ORGANIZACIONES SOCIALES",
        "OTROS ROBOS",
        "ROBO A ESTABLECIMIENTOS DE COLECTIVOS U ORGANIZACIONES SOCIALES",
    ),
    ("ROBO A EMBARCACIONES", "OTROS ROBOS", "ROBO A EMBARCACIONES DE ESPACIOS ACUATICOS"),
    ("ROBO A BIENES DE INSTITUCIONES DE SALUD", "OTROS ROBOS", "OTROS ROBOS"),
    ("ROBO A BIENES DE ENTIDADES FINANCIERAS", "ROBO A UNIDADES ECONOMICAS", "ROBO A UNIDADES ECONOMICAS"),
    ("ROBO A VEHICULOS DE TRANSPORTE DE VALORES", "OTROS ROBOS", "OTROS ROBOS"),
    ("ROBO DE BIENES A ENTIDAD PRIVADA", "ROBO A UNIDADES ECONOMICAS", "ROBO A UNIDADES ECONOMICAS"),
    ("ROBO DE MOTORES EMBARCACIONES", "OTROS ROBOS", "ROBO A EMBARCACIONES DE ESPACIOS ACUATICOS"),
    ("ROBO A BANCOS - ENTIDADES  FINANCIERAS", "ROBO A UNIDADES ECONOMICAS", "ROBO A UNIDADES ECONOMICAS"),
    ("HURTO A PERSONAS", "REVIEW_LABEL", "REVIEW_LABEL"),
    (
        "ROBO A  BOTES PESQUEROS – YATES- FIBRAS-VELEROS ETC.",
        "OTROS ROBOS",
        "ROBO A EMBARCACIONES DE ESPACIOS ACUATICOS",
    ),
    ("HURTO A DOMICILIO", "REVIEW_LABEL", "REVIEW_LABEL"),
    ("HURTO A MOTOS", "REVIEW_LABEL", "REVIEW_LABEL"),
    ("HURTO A BIENES PUBLICOS", "REVIEW_LABEL", "REVIEW_LABEL"),
    ("HURTO A CARROS", "REVIEW_LABEL", "REVIEW_LABEL"),
    ("HURTO A ACCESORIOS", "REVIEW_LABEL", "REVIEW_LABEL"),
    ("HURTO A BIENES DE UNIDADES ECONOMICAS", "REVIEW_LABEL", "REVIEW_LABEL"),
    ("TRANSITO", "REVIEW_LABEL", "REVIEW_LABEL"),
    ("ABIGEATO", "REVIEW_LABEL", "REVIEW_LABEL"),
    ("HURTO A EMBARCACIONES O PARTES EN ESPACIOS ACUATICOS", "REVIEW_LABEL", "REVIEW_LABEL"),
    ("HURTO A BIENES PATRIMONIALES", "REVIEW_LABEL", "REVIEW_LABEL"),
    ("HURTO DE LO REQUISADO", "REVIEW_LABEL", "REVIEW_LABEL"),
    ("ROBO A BIENES PATRIMONIALES", "OTROS ROBOS", "OTROS ROBOS"),
    ("HURTO DE BIENES DE USO POLICIAL O MILITAR", "REVIEW_LABEL", "REVIEW_LABEL"),
)

# --- fixed values: labels repaired in already unified columns ---------------
# (label found, seguimiento, validados)
UNIFIED_REPAIRS = (
    (
        "ROBO DE ACCESORIOS DE VEHICULOS",
        "ROBO DE BIENES, ACCESORIOS Y AUTOPARTES DE VEHICULOS",
        "ROBO DE BIENES, ACCESORIOS Y AUTOPARTES DE VEHICULOS",
    ),
    ("ROBO DE BIENES A ENTIDAD PUBLICA", "OTROS ROBOS", "ROBO EN INSTITUCIONES PUBLICAS"),
    (
        "ROBO DE BIENES PERSONALES AL INTERIOR DEL VEHICULO",
        "ROBO DE BIENES, ACCESORIOS Y AUTOPARTES DE VEHICULOS",
        "ROBO DE BIENES, ACCESORIOS Y AUTOPARTES DE VEHICULOS",
    ),
    ("ROBO DE VEHICULOS", "ROBO DE CARROS", "ROBO DE CARROS"),
    ("ROBO EN VIAS O CARRETERAS", "OTROS ROBOS", "OTROS ROBOS"),
)

# --- fixed values: party roles ----------------------------------------------
PARTY_ROLES = {
    "PRESUNTA_VICTIMA": (
        "VICTIMA",
        "VICTIMA NO RECONOCIDA",
        "DESAPARECIDO",
        "DESAPARECIDO NO RECONOCID",
        "FALLECIDO NO RECONOCIDO",
        "FALLECIDO",
        "PERJUDICADO",
        "PERJUDICADO NO RECONOCIDO",
    ),
    "DENUNCIANTE": ("DENUNCIANTE", "VICTIMA DENUNCIANTE", "VICTIMA-DENUNCIANTE"),
    "SOSPECHOSO": (
        "SOSPECHOSO NO RECONOCIDO",
        "SOSPECHOSO",
        "PROCESADO",
        "PROCESADO NO RECONOCIDO",
        "APREHENDIDO",
        "DETENIDO",
        "APREHENDIDO NO RECONOCIDO",
    ),
}

# --- fixed values: party type codes counted per case ------------------------
PARTY_COUNTS = {
    "APREHENDIDO": (34, 193),
    "SOSPECHOSO": (37, 35),
    "PROCESADO": (53, 194),
    "DETENIDO": (995,),
    "IMPUTADO": (49,),
}

# --- fixed values: procedural stage codes -----------------------------------
STAGES = {
    265: "INVESTIGACION PREVIA",
    266: "INSTRUCCION FISCAL",
    267: "PREPARATORIA DE JUICIO",
    268: "JUICIO",
    1065: "IMPUGNACION",
}
NO_STAGE = "SIN ACCIONES"
NO_STATE = "POR APERTURAR INVETIGACION PREVIA"
PUBLIC_ATTENTION = "ATENCION AL PUBLICO"
# Document state and catalogue of requests.
APPROVED_DOCUMENT, REQUEST_CATALOGUE = 17, 525

# --- fixed values: calendar names -------------------------------------------
MONTHS_SHORT = ("ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic")
MONTHS_FULL = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
WEEKDAYS = ("LUNES", "MARTES", "MIERCOLES", "JUEVES", "VIERNES", "SABADO", "DOMINGO")


def registry_table(spark: SparkSession, scheme: str) -> DataFrame:
    """Registry recode table of a scheme: ``(raw_label, label)``."""
    return _recode_table(spark, REGISTRY_MAPPING, scheme)


def repair_table(spark: SparkSession, scheme: str) -> DataFrame:
    """Recode table for labels already stored in a unified column."""
    return _recode_table(spark, UNIFIED_REPAIRS, scheme)


def _recode_table(spark: SparkSession, entries, scheme: str) -> DataFrame:
    column = 1 + list(SCHEMES).index(scheme)
    return spark.createDataFrame([(e[0], e[column]) for e in entries], "raw_label string, label string")


def party_role_table(spark: SparkSession) -> DataFrame:
    """Raw party role and its group: ``(raw_role, role)``."""
    rows = [(raw, role) for role, raws in PARTY_ROLES.items() for raw in raws]
    return spark.createDataFrame(rows, "raw_role string, role string")

# fixed values: age texts
AGE_GROUPS = (
    "NIÑ@S (DE 0 A 11 AÑOS)",
    "ADOLESCENTES (DE 12 A 17 AÑOS)",
    "JÓVENES (DE 18 A 29 AÑOS)",
    "ADULTOS (DE 30 A 64 AÑOS)",
    "ADULTOS MAYORES (DESDE 65 AÑOS)",
)
AGE_BANDS = (
    "MENORES DE 15 AÑOS",
    "ENTRE 15 Y 24 AÑOS",
    "ENTRE 25 Y 34 AÑOS",
    "ENTRE 35 Y 44 AÑOS",
    "ENTRE 45 Y 64 AÑOS",
    "MAYORES DE 65 AÑOS",
)
MINOR, ADULT = "MENOR DE EDAD", "MAYOR DE EDAD"
