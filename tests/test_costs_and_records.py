"""Hand-made cases for cost reports, record sources and compaction."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import costs as C
from tidemark.operators.latest import hybrid_read, latest, scan_scope_join, superseded_plan
from tidemark.schemas import TABLE_NAMES, record_table
from tidemark.sources import compaction as K
from tidemark.sources import records as R


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_eleven_tables_have_their_grain(spark):
    assert len(TABLE_NAMES) == 11
    for name in TABLE_NAMES:
        t = record_table(name)
        assert set(t.grain) <= {f.name for f in t.schema.fields}
        assert t.prefix == name.replace("_", "-")


def test_latest_prefers_newest_and_ignores_missing_time(frame):
    df = frame([("a", "2026-01-01", 1), ("a", None, 2), ("a", "2026-01-03", 3)], "u string, t string, v int")
    assert rows(latest(df, ["u"], "t"), "v") == [(3,)]


def test_superseded_plan_holds(frame):
    df = frame(
        [("a", "1", "pass"), ("a", None, "pass"), ("b", "1", "pass"), ("b", "2", "fail"), ("c", "1", "fail"), ("c", "2", "pass"), ("d", "1", "pass"), ("e", "2", "pass"), ("e", "2", "pass")],
        "u string, t string, verdict string",
    )
    got = {r["u"]: r["hold"] for r in superseded_plan(df, ["u"], "t", "verdict").collect()}
    assert got == {"a": "record_without_time", "b": "pass_superseded_by_fail", "c": None, "e": "ambiguous_final"}


def test_scan_in_scope_by_one_side_gets_both_halves(frame):
    anat = frame([("s", "2026-01-01", "old", "01")], "subject string, dt string, v string, completed_at string")
    fsqc = frame([("s", "2026-02-01", "new", "02")], "subject string, dt string, v string, completed_at string")
    out = scan_scope_join(anat, fsqc, ["subject"], F.col("dt") >= "2026-02-01", ["v"], ["v"], left_prefix="a_", right_prefix="f_")
    assert rows(out, "subject", "a_v", "f_v") == [("s", "old", "new")]


def test_hybrid_read_counts_a_day_once(frame):
    df = frame([("2026-01-01", 1), ("2026-01-02", 2)], "dt string, v int")
    assert rows(hybrid_read(df, df, "2026-01-02", ["dt", "v"])) == [("2026-01-01", 1), ("2026-01-02", 2)]


POD = (
    "step string, phase string, subject string, node_instance_type string, date string, total_cost_usd double, cpu_cost_usd double, memory_cost_usd double, "
    "gpu_cost_usd double, pv_cost_usd double, network_cost_usd double, node_effective_usd_per_hour double, node_ondemand_usd_per_hour double"
)


def pod(total, effective, listed):
    return ("s", "p", "x", "m5", "2026-01-01", total, total, 0.0, 0.0, 0.0, 0.0, effective, listed)


def test_savings_exclude_unpriced_rows(frame):
    out = C.list_price_savings(frame([pod(2.0, 0.5, 1.0), pod(1.0, None, 1.0), pod(1.0, 0.0, 1.0)], POD)).first()
    assert (out["ondemand_cost_usd"], out["priced_cost_usd"], out["savings_usd"], out["coverage_frac"]) == (4.0, 2.0, 2.0, 0.5)
    none = C.list_price_savings(frame([pod(1.0, None, 1.0)], POD)).first()
    assert none["coverage_frac"] == 0.0 and none["savings_usd"] is None


def test_savings_group_is_whitelisted(frame):
    with pytest.raises(ValueError, match="group_by"):
        C.list_price_savings(frame([pod(1.0, 1.0, 1.0)], POD), "node; drop")


def test_retry_is_summed_then_split(frame):
    pods = frame(
        [("w", "b", "s", "1", 4.0, 1.0, 1.0, 1.0, "2026-01-01", 1), ("w", "b", "s", "1", 2.0, 1.0, 1.0, 1.0, "2026-01-02", 3)],
        "workflow_name string, step string, subject string, session string, total_cost_usd double, cpu_cost_usd double, memory_cost_usd double, gpu_cost_usd double, date string, scrape_age_days int",
    )
    outcomes = frame(
        [("w", "f", "s", "1", "rest", r) for r in "123"] + [("w", "f", "s", "1", "na", "na"), ("w", "surface", "s", "1", "rest", "1")],
        "workflow_name string, step string, subject string, session string, task string, run string",
    )
    out = C.run_costs(pods, outcomes, rename_steps={"f": "b"}, drop_steps=["surface"])
    assert rows(out, "run", "total_cost_usd", "n_runs_in_pod") == [("1", 2.0, 3), ("2", 2.0, 3), ("3", 2.0, 3)]


def test_workflow_over_midnight_is_one_total(frame):
    runs = frame([("s", "1"), ("s", "2")], "subject string, run string")
    workflows = frame([("w", "s", "Succeeded", 5, "2")], "workflow_name string, subject string, status string, total_duration_s int, completed_at string")
    costs = frame([("w", "d1", 1.0), ("w", "d2", 2.0)], "workflow_name string, date string, total_cost_usd double")
    out = C.subject_run_report(runs, workflows, costs)
    assert rows(out, "run", "total_cost_usd") == [("1", 3.0), ("2", 3.0)]


def test_shared_row_sums_to_the_original(frame):
    costs = frame([("w", "d", "", 8.0)], "workflow_name string, date string, subject string, total_cost_usd double")
    claims = frame([("w", "d", "a", 0.25), ("w", "d", "b", 0.75)], "workflow_name string, date string, subject string, share double")
    assert rows(C.scope_to_claims(costs, claims), "subject", "total_cost_usd") == [("a", 2.0), ("b", 6.0)]


def test_unsettled_session_cost_is_refused(frame):
    pods = frame(
        [("w", "1", 2.0, 3), ("w", None, 4.0, 3), ("x", "1", 2.0, 1)], "workflow_name string, session string, total_cost_usd double, scrape_age_days int"
    )
    sessions = frame([("w", "1", 2), ("w", "2", 1), ("x", "1", 1)], "workflow_name string, session string, n_runs int")
    out = C.session_cost_report(pods, sessions=sessions)
    assert rows(out, "workflow_name", "session", "session_usd") == [("w", "1", 4.0), ("w", "2", 2.0), ("x", "1", None)]


def test_carried_identity_drops_the_rate(frame):
    schema = "pod string, instance string, rate double"
    new = frame([("a", "i1", 1.0), ("b", "", 2.0), ("c", "i9", 3.0)], schema)
    stored = frame([("b", "i2", 9.0), ("c", "i3", 9.0), ("a", "", 1.0)], schema)
    out = C.carry_proven(new, stored, ["pod"], ["instance"], "rate")
    assert rows(out, "pod", "instance", "rate") == [("a", "i1", 1.0), ("b", "i2", None), ("c", "i3", None)]


def test_null_keys_are_never_removed(frame):
    df = frame([("a", "1"), ("a", None), ("b", "1")], "s string, t string")
    keys = frame([("a", "1")], "s string, t string")
    assert rows(K.drop_rows(df, ["s", "t"], keys)) == [("a", None), ("b", "1")]
    assert rows(K.drop_rows(df, ["s", "t"], keys, complement=True)) == [("a", "1"), ("a", None)]
    with pytest.raises(K.UnattributableRows):
        K.drop_rows(df, ["missing"], keys)


def write(spark, root, rows_, mode="append"):
    df = spark.createDataFrame(rows_, "subject string, session string, task string, run string, mean_fd double, schema_version string, pipeline string, dt string")
    R.write_records(df, f"{root}/func-preproc", mode)


def read_back(spark, root):
    t = record_table("func_preproc")
    return spark.read.schema(t.partitioned_schema).parquet(t.compacted_path(root))


def test_compaction_versions_orphans_and_late_records(spark, tmp_path):
    root = str(tmp_path)
    day = "2026-01-01"
    write(spark, root, [("s", "1", "rest", "1", 0.1, "1.1", "m", day), ("s", "1", "rest", "2", 0.2, None, "m", day)])
    report = K.compact_days(spark, root, "func_preproc", [day, "2026-01-02"])
    assert report.written == {(day, "1.1"): 1, (day, "unknown"): 1}
    assert report.skipped == {"2026-01-02": "no raw records"}
    # a late record for the closed day: the whole day is rebuilt
    write(spark, root, [("s", "1", "rest", "3", 0.3, "1.1", "m", day)])
    K.compact_days(spark, root, "func_preproc", [day])
    assert rows(read_back(spark, root), "run", "schema_version") == [("1", "1.1"), ("2", "unknown"), ("3", "1.1")]
    # the version of all rows moves on: the old partition reads as no rows but stays
    other = str(tmp_path / "again")
    write(spark, other, [("s", "1", "rest", "1", 0.1, "1.2", "m", day)])
    t = record_table("func_preproc")
    again = K.compact_days(spark, other, "func_preproc", [day], compacted_path=t.compacted_path(root))
    assert again.emptied == [(day, "1.1"), (day, "unknown")]
    assert rows(read_back(spark, root), "run", "schema_version") == [("1", "1.2")]


def test_unreadable_record_leaves_the_day_alone(spark, tmp_path):
    root, day = str(tmp_path), "2026-01-01"
    write(spark, root, [("s", "1", "rest", "1", 0.1, "1.1", "m", day)])
    K.compact_days(spark, root, "func_preproc", [day])
    write(spark, root, [("s", "1", "rest", "2", 0.2, "1.1", "m", day)])
    (tmp_path / "func-preproc" / f"dt={day}" / "bad.json").write_text('{"subject": "s", \n')
    report = K.compact_days(spark, root, "func_preproc", [day])
    assert report.skipped == {day: "unreadable raw records"} and not report.written
    assert rows(read_back(spark, root), "run") == [("1",)]


def test_json_and_jsonl_files(spark, tmp_path):
    (tmp_path / "one.json").write_text('{\n  "a": 1,\n  "b": "x"\n}\n')
    (tmp_path / "many.json").write_text('{"a": 2}\n\n{"a": 3}\n{"a": \n')
    (tmp_path / "none.json").write_text("not json")
    schema = R.T.StructType.fromDDL("a INT, b STRING")
    df = R.read_json_or_jsonl(spark, str(tmp_path), schema)
    good = df.filter(F.col(R.CORRUPT).isNull())
    assert rows(good, "a") == [(1,), (2,), (3,)]
    assert R.unreadable_count(df) == 2


def test_missing_column_reads_null_and_dt_is_text(spark, tmp_path):
    write(spark, str(tmp_path), [("s", "1", "rest", "1", 0.1, "1.1", "m", "2026-01-01")])
    r = R.scan_raw(spark, str(tmp_path), "func_preproc").first()
    assert r["tsnr_median"] is None and r["dt"] == "2026-01-01"


def test_effective_rate_without_minutes(frame):
    df = frame([("n", 0.0, 5.0, "", 1.0), ("m", 30.0, 5.0, "reserved", None)], "node string, minutes double, total_cost double, capacity_label string, preemptible double")
    assert rows(C.effective_rates(df, ["node"])) == [("m", 10.0, "reserved"), ("n", None, "spot")]
