"""The jobs: idempotence, plans, partition counts, streaming, files."""

import datetime as dt
import re

import pytest
from small import SMALL
from pyspark.sql import functions as F

from caselabel.catalog import REGISTRY
from caselabel.catalog import roles as ro
from caselabel.operators import cases as cs
from caselabel.operators import keys as ky
from caselabel.operators import labels as lo
from caselabel.operators import snapshots as sn
from caselabel.plans.evaluate import evaluate
from caselabel.plans.refresh import prepare, refresh
from caselabel.plans.weekly import apply_update, weekly_run
from caselabel.session import workspace
from caselabel.sources import files, sinks
from caselabel.streaming.incremental import run_available

# queries whose point is a Python boundary: plugged-in models
PYTHON = {"plug_in_score", "plug_in_score_windows", "plug_in_decoded_pages"}
TRAINED = {"train_classifier", "train_early_stopping", "predict_probability", "save_load_model"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def role(spark):
    return ro.Roles(spark, SMALL)


def cases_of(role):
    return role.cases().drop("lang", "source", "n_chars", "doc_id")


def test_weekly_run_settles(role):
    """A second run only fills labels the commission left open; a third changes nothing."""
    cases, commission = cases_of(role), role.commission()

    def run(table):
        return apply_update(table, weekly_run(table, commission, role.scorers(), ro.RUN_TIME))

    once = run(cases)
    twice = run(once)
    assert once.count() == cases.count()
    label = "delitos_seguimiento_unified_comision"
    changed = ky.row_difference(once, twice, "left_only")
    assert changed.where(F.col(label).isNotNull()).count() == 0
    assert {r[0] for r in changed.select(f"{label}_origin").collect()} <= {"COMISION"}
    assert ky.row_difference(twice, run(twice)).count() == 0


def test_weekly_run_with_one_model(role):
    cases = cases_of(role)
    out = weekly_run(cases, None, {"seguimiento": role.scorer("seguimiento")}, ro.RUN_TIME, registry=False)
    scored = cases.where("ESTADO_ML = 0").select("NDD").join(out, "NDD").where("CANTIDAD_PALABRAS >= 50")
    assert {r[0] for r in scored.select("ESTADO_ML").distinct().collect()} == {3}
    kept = ["NDD", "delitos_validados_predicted", "delitos_validados_unified_siaf"]
    assert ky.row_difference(out.select(*kept), cases.select(*kept)).count() == 0


def test_weekly_run_shuffles_no_text(role):
    plan = plan_of(weekly_run(cases_of(role), role.commission(), role.scorers(), ro.RUN_TIME))
    assert "EvalPython" not in plan
    assert "RoundRobinPartitioning" not in plan
    for node in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan):
        assert "RELATO" not in node


@pytest.mark.parametrize("name", ["scan_cases", "scan_commission", "full_or_new_mode", "update_from", "case_detail", "lexicon_score_table", "seeded_sample"])
def test_no_table_is_shuffled_to_spread_it_or_gathered_raw(spark, name):
    plan = plan_of(REGISTRY[name].run(spark, SMALL))
    assert "RoundRobinPartitioning" not in plan
    for node in re.findall(r"Exchange SinglePartition.*\n([^\n]*\n[^\n]*)", plan):
        assert re.search(r"functions=\[(partial_|merge_|\])|LocalLimit|TakeOrdered|LocalTableScan|Window", node), node


def test_refresh_is_idempotent(role):
    cases = prepare(cases_of(role).select("NDD", "RELATO"), F.col("RELATO")).select("NDD", "relato", "cantidad_palabras")
    scorers = {f"delitos_{s}": role.scorer(s, "relato") for s in ("seguimiento", "validados")}
    order = [F.col("FechaActualizacion"), F.xxhash64("relato")]
    first = refresh(cases, role.previous(), scorers, ro.RUN_TIME, order)
    second = refresh(cases, first, scorers, dt.datetime(2030, 1, 1), order)
    assert first.count() == cases.count()
    assert ky.row_difference(first, second).count() == 0


def test_partition_count_does_not_matter(spark, role):
    def run(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        try:
            return sorted(map(str, weekly_run(cases_of(role), role.commission(), role.scorers(), ro.RUN_TIME).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    assert run(1) == run(8)


def test_evaluation_frames(role):
    scored = lo.gate_and_score(role.norm(), role.scorer("seguimiento"), "words", "pred", "score").select("NDD", "pred")
    out = evaluate(scored, role.commission(), "pred", [F.col("delitos_seguimiento_comision")])
    known = out["pairs"].where("y_pred IS NOT NULL").count()
    assert out["report"].where("label = 'accuracy'").collect()[0].support == known
    assert out["matrix"].count() == 49 and out["accuracy"].collect()[0].n == known


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - TRAINED))
def test_plan(spark, name):
    """No cross joins, no row-at-a-time Python, Arrow only where a user's code runs."""
    plan = plan_of(REGISTRY[name].run(spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    assert ("ArrowEvalPython" in plan) == (name in PYTHON)


def test_stream_equals_batch_and_survives_replay(spark, role, tmp_path):
    arrived = prepare(cases_of(role).select("NDD", "RELATO"), F.col("RELATO")).select("NDD", "relato", "cantidad_palabras")
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    scorer = role.scorer("seguimiento", "relato")

    def process(fresh):
        return lo.gate_and_score(fresh, scorer, "cantidad_palabras", "label", "score")

    def pull():
        run_available(spark, source, arrived.schema, target, checkpoint, "NDD", [F.xxhash64("relato")], process, files_per_batch=2)

    half = F.col("NDD") < "000000000000120"
    arrived.where(half).coalesce(3).write.parquet(source)
    pull()
    arrived.coalesce(2).write.mode("append").parquet(source)  # holds the first half again
    pull()
    pull()
    stored = spark.read.parquet(target).drop("batch_id")
    expected = process(arrived)
    assert stored.count() == arrived.count()
    assert ky.row_difference(stored, expected.select(*stored.columns)).count() == 0


def test_csv_keeps_keys_and_bad_lines(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('NDD,words\n000000000000012,5\n000000000000013,many\n', encoding="utf8")
    out = files.read_csv_typed(spark, str(path), "NDD string, words int").collect()
    assert [r.NDD for r in out] == ["000000000000012", "000000000000013"]
    assert out[0]["_corrupt_record"] is None and "many" in out[1]["_corrupt_record"]


def test_yearly_csv_files(spark, tmp_path):
    (tmp_path / "robos_2019.csv").write_text("a,b\n12,uno\n", encoding="utf8")
    (tmp_path / "2020-robos.csv").write_text("ndd,relato\n000000000000013,dos\n", encoding="utf8")
    paths = [str(tmp_path / n) for n in ("robos_2019.csv", "2020-robos.csv")]
    out = files.read_yearly_files(spark, paths, fmt="csv").orderBy("anio").collect()
    assert [tuple(r) for r in out] == [("000000000000012", "uno", 2019), ("000000000000013", "dos", 2020)]


def test_period_name(rows):
    frame = rows("n string", ("INEC_20230801_20230815_x",), ("otra",))
    assert [r[0] for r in frame.select(sinks.period_name(F.col("n"))).collect()] == ["robosAI_010823_150823", "RobosAI"]


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("b_left", "b_right"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            frame = spark.range(1000).select(F.col("id").cast("string").alias("NDD"), F.col("id").alias(name))
            sinks.save_bucketed(frame, name, "NDD", 4, path=str(tmp_path / name))
        plan = plan_of(spark.table("b_left").join(spark.table("b_right"), "NDD"))
        assert "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        for name in ("b_left", "b_right"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


class FakeSession:
    """A session that knows only what ``workspace`` asks for."""

    def __init__(self, master, folder):
        self.sparkContext = self.conf = self
        self.master, self.folder = master, folder

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.folder or default


def test_workspace_uses_the_shared_folder(spark):
    assert workspace(FakeSession("spark://host:7077", "/shared/place/"), "x").startswith("/shared/place/x-")
    assert workspace(spark, "x") != workspace(spark, "x")
    with pytest.raises(ValueError):
        workspace(FakeSession("yarn", None), "x")


def test_settle_keeps_what_only_the_previous_snapshot_has(rows):
    current = rows("NDD string, delitos_seguimiento string, score_delitos_seguimiento double, new int", ("1", "A", 0.1, 7), ("2", "B", 0.2, 8))
    previous = rows(
        "NDD string, delitos_seguimiento string, score_delitos_seguimiento double, delitos_validados string,"
        " score_delitos_validados double, compare string, nota string, FechaActualizacion timestamp",
        ("1", "X", 0.9, "X", 0.8, "CHECK", "mine", dt.datetime(2020, 1, 1)),
    )
    now = dt.datetime(2024, 2, 1)
    out = sn.merge_snapshots(current, previous, "NDD", ["delitos_seguimiento"], now, [F.col("nota")])
    got = {r.NDD: r for r in out.collect()}
    assert "new" not in out.columns and set(out.columns) == set(previous.columns)
    assert tuple(got["1"][c] for c in ("delitos_seguimiento", "delitos_validados", "compare", "nota")) == ("X", "X", "OK", "mine")
    assert got["1"].FechaActualizacion == dt.datetime(2020, 1, 1) and got["2"].FechaActualizacion == now
    assert (got["2"].delitos_seguimiento, got["2"].delitos_validados, got["2"].nota, got["2"].compare) == ("B", None, None, "CHECK")


def test_update_refuses_unknown_columns(rows):
    target, source = rows("k string, a int", ("x", 1)), rows("k string, b int", ("x", 2))
    for columns in (["a"], ["b"]):
        with pytest.raises(ValueError):
            sn.update_from(target, source, "k", columns, [F.lit(1)])


@pytest.mark.parametrize("write, read", [({}, {"multiline": True}), ({"escape_lines": True}, {"escaped_lines": True})])
def test_csv_keeps_texts_as_they_are(spark, rows, tmp_path, write, read):
    texts = ["plain", "", None, 'a "quoted", text', "two\nlines\r\nand \\n a \\ backslash\\", " blank ends ", "ñandú", '""', "x\\"]
    frame = rows("k string, t string", *[(str(i), t) for i, t in enumerate(texts)])
    path = sinks.save_csv(frame, str(tmp_path), "texts", dt.date(2024, 1, 1), **write)
    got = files.read_csv_typed(spark, path, "k string, t string", **read)
    found = got.orderBy(F.col("k").cast("int")).collect()
    assert all(r._corrupt_record is None for r in found)
    assert [r.t for r in found] == texts


def test_repeated_lookup_rows_do_not_multiply(rows):
    names = rows("code string, name string", ("a", "first"), ("a", "second"), ("b", "other"))
    out = cs.named(rows("k int, c string", (1, "a"), (2, "b"), (3, None)), names, F.col("c"), "out")
    assert {(r.k, r.out) for r in out.collect()} == {(1, "second"), (2, "other"), (3, None)} and out.count() == 3


def test_repeated_mapping_entries_do_not_multiply(rows):
    mapping = rows("raw_label string, label string", ("a", "X"), ("a", "Y"))
    assert [r.c for r in lo.recode(rows("c string", ("a",), ("b",)), "c", mapping).collect()] == ["X", "b"]


@pytest.mark.parametrize("name", ["case_detail", "case_activity"])
def test_cases_are_not_dealt_by_a_few_court_codes(spark, name):
    assert "hashpartitioning(fuero" not in plan_of(REGISTRY[name].run(spark, SMALL))


def test_phase_dates_by_hand_without_a_shuffle_by_unit(spark):
    phases = [
        ("a", 1, "IP", 1, 3, 4, 9), ("a", 1, "IP", 1, 2, 7, 9), ("a", 2, "INS", 1, 8, 8, 8), ("a", 1, "INS", 0, 9, 9, 9),
        ("a", 1, "INS", 1, 5, 6, 30), ("b", None, "IP", 1, 1, 1, 1), ("c", 3, "IP", 1, 1, 1, 1), (None, 1, "IP", 1, 1, 1, 1),
    ]
    frame = spark.createDataFrame(phases, "NDD string, unidad long, fase string, estado int, inicio int, fin int, tiempo int")
    chosen = spark.createDataFrame([("a", 1), ("b", None), ("d", 3), (None, 1)], "NDD string, unidad long")
    out = cs.phase_dates(frame, chosen)
    assert {r[0]: r[1:] for r in out.collect() if any(v is not None for v in r[1:])} == {"a": (3, 7, 5, 6, 30)}
    assert not re.search(r"hashpartitioning\([^)]*unidad", plan_of(out))
