"""Case detail from a star of header, assignment, party and activity tables.

Child tables are reduced to one row per case before they are joined, each
scanned once.  Lookup tables are reduced to one name per code, so a repeated
code never multiplies cases, and joined plainly: the planner broadcasts them by
their measured size.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.functions import labels as lb
from caselabel.functions import text as tx
from caselabel.operators import keys as ky


@dataclass(frozen=True)
class CaseTables:
    """The tables a case file is put together from.

    Lookups have ``code, name``; ``cantons`` also has ``state``.  ``units`` has
    ``unidad, especialidad, provincia, canton, numero, edificio, fiscal``,
    ``offences`` has ``code, name, full_name``.
    """

    headers: DataFrame
    assignments: DataFrame
    units: DataFrame
    offences: DataFrame
    states: DataFrame
    courts: DataFrame
    offices: DataFrame
    cities: DataFrame
    cantons: DataFrame
    parishes: DataFrame
    incident_kinds: DataFrame
    provinces: DataFrame
    parties: DataFrame
    last_actions: DataFrame
    phases: DataFrame
    proceedings: DataFrame
    tasks: DataFrame


def one_name(lookup: DataFrame, *names: str) -> DataFrame:
    """One row per code; of several names the largest."""
    return lookup.groupBy("code").agg(*[F.max(n).alias(n) for n in names or ("name",)])


def named(df: DataFrame, lookup: DataFrame, code: Column, out: str) -> DataFrame:
    """Add a code's name; unknown codes get NULL."""
    names = one_name(lookup).select(F.col("code").alias("_code"), F.col("name").alias("_name"))
    return df.join(names, code == F.col("_code"), "left").withColumn(out, F.col("_name")).drop("_code", "_name")


def party_counts(parties: DataFrame, key: str) -> DataFrame:
    """Active parties per case and kind, in one aggregation."""
    return (
        parties.where(F.col("inv_estado") == 1)
        .groupBy(key)
        .agg(*[F.count_if(F.col("inv_idtipo").isin(*codes)).alias(name) for name, codes in vocab.PARTY_COUNTS.items()])
    )


def phase_dates(phases: DataFrame, chosen: DataFrame, key: str = "NDD", unit: str = "unidad") -> DataFrame:
    """Latest start and end of the two investigation phases, and the longest term, in the unit chosen for each case.

    ``phases`` has ``key, unit, fase, estado, inicio, fin, tiempo`` with phase IP
    or INS, ``chosen`` one unit a key.  They meet by the key alone and the unit is
    compared in the aggregate, so both stay partitioned as the aggregate and the
    report's joins want them.
    """
    active = phases.where(F.col("estado") == 1).join(chosen.select(key, F.col(unit).alias("_unit")), key)

    def last(phase: str, column: str) -> Column:
        return F.max(F.when((F.col("fase") == phase) & (F.col(unit) == F.col("_unit")), F.col(column)))

    return active.groupBy(key).agg(
        last("IP", "inicio").alias("Fecha_IP_Inicio"),
        last("IP", "fin").alias("Fecha_IP_Fin"),
        last("INS", "inicio").alias("Fecha_INS_Inicio"),
        last("INS", "fin").alias("Fecha_INS_Fin"),
        last("INS", "tiempo").alias("Tiempo_INS"),
    )


def phase_span(phases: DataFrame, key: str = "NDD") -> DataFrame:
    """First start and last end of either phase per case; each row counts by its own state."""

    def of(phase: str, column: str) -> Column:
        return F.when(F.col("fase") == phase, F.col(column))

    return phases.where(F.col("estado") == 1).groupBy(key).agg(
        F.min(of("IP", "inicio")).alias("ind_fecha_ini"),
        F.max(of("IP", "fin")).alias("ind_fecha_fin"),
        F.min(of("INS", "inicio")).alias("ins_fecha_inicio"),
        F.max(of("INS", "fin")).alias("ins_fecha_cierre"),
    )


def activity_counts(proceedings: DataFrame, tasks: DataFrame, key: str = "NDD") -> tuple[DataFrame, DataFrame]:
    """Active proceedings per case, and different active tasks per case that belong to an active proceeding.

    A task names its proceeding (``proceso``); the case is the task's own.
    """
    active = proceedings.where(F.col("estado") == 1)
    impulses = active.groupBy(key).agg(F.count(key).alias("IMPULSOS"))
    own = tasks.where(F.col("estado") == 1).join(active.select("proceso").distinct(), "proceso", "left_semi")
    return impulses, own.groupBy(key).agg(F.count_distinct("tarea").alias("IMPULSOS_DILIGENCIAS"))


def valid_headers(headers: DataFrame) -> DataFrame:
    """Case headers in force."""
    return headers.where((F.col("estado") == 1) & (F.col("anulada") == "NO"))


def active_assignment() -> Column:
    """Assignments in force."""
    return F.col("fso_estado") < 3


def merged_assignment() -> Column:
    """Assignments of cases accumulated into another one."""
    return F.col("fso_estado") == 6


_FULL_OFFENCE = "Presunto Delito (Circunstancia Modificatoria)"
#: Columns that every kind of detail starts with, in the order of the reports.
_OPENING = (
    "NDD", "Fecha_Registro", "Hora_Registro", "Fecha_Incidente", "Hora_Incidente", "Tentativa", "Direccion", "Presunto_Delito",
    _FULL_OFFENCE, "Fiscalia", "Fiscalia_Especializada", "Ciudad", "PROVINCIA", "Canton", "Parroquia", "Tipo", "NyF",
    "numero_fiscalia", "edificio", "nombre_fiscal", "Fuero", "Etapa_procesal", "Estado_Procesal",
)
_ACTIONS = ("Ultima_accion", "Fecha_Ultima_Accion", *vocab.PARTY_COUNTS, "numeroinf", "Tipo_incidente")
_PHASES = ("Fecha_IP_Inicio", "Fecha_IP_Fin", "Fecha_INS_Inicio", "Fecha_INS_Fin", "Tiempo_INS")
_SPAN = ("ind_fecha_ini", "ind_fecha_fin", "ins_fecha_inicio", "ins_fecha_cierre")

#: Columns of the three kinds of detail.
DETAIL = (*_OPENING, "Fecha_estado_procesal", "IMPULSOS_DILIGENCIAS", "IMPULSOS", *_ACTIONS, *_PHASES, "Relato", "PROVINCIA_INCIDENTE", "CANTON_INCIDENTE")
MERGED = (*_OPENING, "IMPULSOS_DILIGENCIAS", *_ACTIONS, "Relato", "fso_acumulado")
ACTIVITY = (*_OPENING, "IMPULSOS_DILIGENCIAS", "IMPULSOS", *_ACTIONS, *_SPAN, "Relato")


def case_rows(
    tables: CaseTables,
    which: Column,
    columns: tuple[str, ...],
    keys: DataFrame | None = None,
    clean: Callable[[Column], Column] = tx.strip_tags,
) -> DataFrame:
    """One row per case with ``columns``: header, latest matching assignment, names, counts and dates.

    ``which`` selects the assignments, ``clean`` turns the stored narrative into
    text.  With ``keys`` only those cases are detailed; the child tables are cut
    down to them before they are aggregated.
    """
    cases, assignments = valid_headers(tables.headers), tables.assignments
    parties, phases, proceedings, tasks = tables.parties, tables.phases, tables.proceedings, tables.tasks
    if keys is not None:
        cases, assignments, parties, phases, tasks = (ky.semi_known(x, keys, "NDD") for x in (cases, assignments, parties, phases, tasks))
    units = tables.units.groupBy("unidad").agg(*[F.max(c).alias(c) for c in ("especialidad", "provincia", "numero", "edificio", "fiscal")])
    chosen = ky.dedupe_last(
        assignments.where(which).join(units.select("unidad"), "unidad", "left_semi"),
        ["NDD"],
        [F.col("fso_fecha"), F.col("unidad"), F.col("fso_orden")],
        keep=["unidad", "estado_procesal", "fso_etapas", "fso_acumulado", "fso_fecha_estado_procesal"],
    )
    offences = one_name(tables.offences, "name", "full_name").withColumnsRenamed({"code": "infraccion", "name": "Presunto_Delito", "full_name": _FULL_OFFENCE})
    impulses, own_tasks = activity_counts(proceedings, tasks)
    rows = cases.join(chosen, "NDD")
    if set(_PHASES) & set(columns):
        rows = rows.join(phase_dates(phases, chosen), "NDD", "left")
    if set(_SPAN) & set(columns):
        rows = rows.join(phase_span(phases), "NDD", "left")
    if "IMPULSOS" in columns:
        rows = rows.join(impulses, "NDD", "left")
    rows = (
        rows.join(own_tasks, "NDD", "left")
        .join(party_counts(parties, "NDD"), "NDD", "left")
        .join(tables.last_actions, "NDD", "left")
        .join(units, "unidad")
        .join(offences, "infraccion")
    )
    cantons = tables.cantons
    lookups = (
        (tables.offices, F.col("fiscalias"), "Fiscalia"),
        (tables.cities, F.col("ciudades"), "Ciudad"),
        (cantons.where(F.col("state") == "1"), F.substring("parroquias", 1, 4), "Canton"),
        (tables.parishes, F.col("parroquias"), "Parroquia"),
        (tables.incident_kinds, F.col("tipoincidente"), "Tipo"),
        (tables.courts, F.col("fuero"), "Fuero"),
        (tables.states, F.col("estado_procesal"), "Estado_Procesal"),
        (tables.provinces, F.col("provincias"), "PROVINCIA_INCIDENTE"),
        (cantons, F.col("cantones"), "CANTON_INCIDENTE"),
    )
    values = {}
    for i, (lookup, code, out) in enumerate(lookups):
        if out in columns:
            names = one_name(lookup).select(F.col("code").alias(f"_code{i}"), F.col("name").alias(f"_name{i}"))
            rows = rows.join(names, code == F.col(f"_code{i}"), "left")
            values[out] = F.col(f"_name{i}")
    values |= {
        "Tentativa": lb.yes_no(F.col("tentativa")),
        "Fiscalia_Especializada": F.col("especialidad"),
        "NyF": F.when(F.col("tipodelito") == 0, "No Flagrante").otherwise("Flagrante"),
        "numero_fiscalia": F.concat(F.lit("Fiscalia "), F.col("numero").cast("string")),
        "nombre_fiscal": F.col("fiscal"),
        "Etapa_procesal": lb.stage_text(F.col("fso_etapas")),
        "Estado_Procesal": lb.state_text(values["Estado_Procesal"]),
        "Fecha_estado_procesal": F.date_format("fso_fecha_estado_procesal", "yyyy-MM-dd"),
        "Tipo_incidente": values["Tipo"],
        "Relato": clean(F.col("obserinc")),
        **{name: F.coalesce(F.col(name), F.lit(0)) for name in ("IMPULSOS_DILIGENCIAS", "IMPULSOS", *vocab.PARTY_COUNTS)},
    }
    return rows.select(*[values.get(c, F.col(f"`{c}`")).alias(c) for c in columns])


def case_detail(tables: CaseTables, **options) -> DataFrame:
    """Full detail of the cases in force; see ``case_rows`` for the options."""
    return case_rows(tables, active_assignment(), DETAIL, **options)


def case_detail_merged(tables: CaseTables, **options) -> DataFrame:
    """Detail of cases accumulated into another one."""
    return case_rows(tables, merged_assignment(), MERGED, **options)


def case_activity(tables: CaseTables, **options) -> DataFrame:
    """Detail with the counts of tasks and proceedings, absent ones as 0, and the span of the phases."""
    return case_rows(tables, active_assignment(), ACTIVITY, **options)


def proceeding_detail(
    kinds: DataFrame, requests: DataFrame, documents: DataFrame, proceedings: DataFrame, units: DataFrame, officials: DataFrame
) -> DataFrame:
    """Requests of active kinds with their document, proceeding, unit, prosecutor and secretary.

    Documents and proceedings match on case, unit and their own number; only
    approved documents of the requests' catalogue count.  Officials are looked
    up by code and by identity number, one name each.
    """
    on_case = ["NDD", "unidad"]
    name = F.concat("paterno", F.lit(" "), "materno", F.lit(" "), "nombres")
    by_code = officials.select(F.col("funcionario").alias("code"), name.alias("name"))
    by_card = officials.select(F.col("cedula").alias("code"), name.alias("name"))
    places = units.groupBy("unidad").agg(*[F.max(c).alias(c) for c in ("provincia", "canton", "edificio", "especialidad")])
    rows = (
        requests.where(F.col("estado_dil") != -1)
        .join(one_name(kinds.where(F.col("estado") == 1)).withColumnsRenamed({"code": "tipo", "name": "TIPO_DILIGENCIA"}), "tipo")
        .join(documents.where((F.col("estado_doc") == vocab.APPROVED_DOCUMENT) & (F.col("catalogo") == vocab.REQUEST_CATALOGUE)), [*on_case, "documento"])
        .join(proceedings.where(F.col("estado") == 1).select(*on_case, "proceso", "no_resolucion"), [*on_case, "proceso"])
        .join(places, "unidad")
    )
    rows = named(named(rows, by_code, F.col("aprobado"), "FISCAL"), by_card, F.col("cedula_secretario"), "SECRETARIO")
    return rows.select(
        "FISCAL",
        "SECRETARIO",
        "NDD",
        F.col("provincia").alias("PROVINCIA"),
        F.col("canton").alias("CANTON"),
        F.col("edificio").alias("EDIFICIO"),
        F.col("especialidad").alias("ESPECIALIDAD"),
        F.when(F.col("estado_dil") == 0, "SOLICITADO").otherwise("RECIBIDO/ESCANEO").alias("ESTADO_DLIGENCIA"),
        F.col("numero").alias("NUMERO_OFICIO"),
        F.date_format("fecha_crea", "yyyy-MM-dd").alias("FECHA"),
        F.col("no_resolucion").alias("NO_IMPULSO"),
        "TIPO_DILIGENCIA",
    )


def case_state(headers: DataFrame, assignments: DataFrame, courts: DataFrame, states: DataFrame) -> DataFrame:
    """Distinct court, stage and state of each case with an active assignment."""
    rows = valid_headers(headers).join(assignments.where(active_assignment()), "NDD")
    rows = named(named(rows, courts, F.col("fuero"), "Fuero"), states, F.col("estado_procesal"), "descripcion_estado")
    return rows.select(
        "NDD",
        "Fuero",
        lb.stage_text(F.col("fso_etapas")).alias("Etapa_procesal"),
        lb.state_text(F.col("descripcion_estado")).alias("Estado_Procesal"),
    ).distinct()


def _attention(log: DataFrame, provinces: DataFrame, cantons: DataFrame, buildings: DataFrame, users: DataFrame, start, end) -> DataFrame:
    """Log rows of a date range with the names of place, building and user; rows without a place or building go."""
    rows = log.where(F.col("avd_fecha_ini").between(F.lit(start), F.lit(end)))
    for lookup, code, out in ((provinces, "pro_codigo", "PROVINCIA"), (cantons, "can_codigo", "CANTON"), (buildings, "edi_codigo", "EDIFICIO")):
        rows = rows.join(one_name(lookup).withColumnsRenamed({"code": code, "name": out}), code)
    people = one_name(users, "name", "card").withColumnsRenamed({"code": "usu_codigo", "name": "_user", "card": "_card"})
    return rows.join(people, "usu_codigo", "left")


def non_offence_visits(
    log: DataFrame, provinces: DataFrame, cantons: DataFrame, buildings: DataFrame, kinds: DataFrame, users: DataFrame, start, end
) -> DataFrame:
    """Public attention in a date range; visits without a kind are general attention."""
    rows = _attention(log.where(F.col("avd_estado").isin(1, 2)), provinces, cantons, buildings, users, start, end)
    return named(rows, kinds, F.col("avd_abreviado"), "_kind").select(
        F.col("avd_fecha_ini").alias("FECHA"),
        "PROVINCIA",
        "CANTON",
        "EDIFICIO",
        F.coalesce("_kind", F.lit(vocab.PUBLIC_ATTENTION)).alias("NO_DELITO"),
        F.col("avd_abreviado").alias("ABREVIADO"),
        F.col("avd_hora_ini").alias("horaInicio"),
        F.col("_user").alias("NOMBRE"),
        F.col("_card").alias("CEDULA"),
    )


def admin_acts(
    log: DataFrame, provinces: DataFrame, cantons: DataFrame, buildings: DataFrame, kinds: DataFrame, users: DataFrame, start, end
) -> DataFrame:
    """Administrative acts in a date range; only known kinds count."""
    acts = log.where((F.col("avd_estado") != 0) & (F.col("avd_aa") != 0))
    rows = _attention(acts, provinces, cantons, buildings, users, start, end)
    return named(rows, kinds, F.col("avd_abreviado"), "DESCRIPCION_AVD").where("DESCRIPCION_AVD IS NOT NULL").select(
        F.col("avd_fecha_ini").alias("FECHA_INICIO"),
        "PROVINCIA",
        "CANTON",
        "EDIFICIO",
        "DESCRIPCION_AVD",
        "avd_abreviado",
        F.col("_user").alias("nombreUsuario"),
        F.col("_card").alias("cedulaUsuario"),
    )


def matrix_filter(matrix: DataFrame, kind: str, value: str, dates: dict[str, str]) -> DataFrame:
    """Rows of one kind from a typed matrix, its text dates parsed by format."""
    parsed = {c: F.try_to_timestamp(F.col(c), F.lit(fmt)) for c, fmt in dates.items()}
    return matrix.where(F.col(kind) == value).withColumns(parsed)
