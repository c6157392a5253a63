import os
import shutil
import time
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratalake import schemas as S
from stratalake.operators.merge import match
from stratalake.plans import gold as G
from stratalake.plans import reports, run
from stratalake.session import CLEANUP, shared_dir
from stratalake.sources.snapshots import Layout, Store, dense
from tests.sources import CLEAN, write_sources

D1, D2, D3 = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)
TS1, TS2 = datetime(2024, 1, 1), datetime(2024, 2, 1)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


MONTHS = [f"{i},{1 + i % 2},{1 + i % 2},1,1,2023-{1 + i % 12:02d}-{1 + i % 28:02d},09:00,30,{'Resting' if i == 7 else 'Completed'},50.00,ok"
          for i in range(1, 61)]


@pytest.fixture(scope="module")
def loads(spark, tmp_path_factory):
    """Warehouses after their first load, and its metrics; tests that change one take a copy."""
    folder, made = tmp_path_factory.mktemp("loads"), {}
    for name, changed in (("clean", {}), ("months", {"appointments": MONTHS})):
        made[name] = str(folder / name), run.run_pipeline(spark, write_sources(folder / f"in-{name}", **changed), str(folder / name), D1, strict=True)
    return made


@pytest.fixture
def clean_load(loads, tmp_path):
    return shutil.copytree(loads["clean"][0], str(tmp_path / "wh"))


@pytest.fixture
def months_load(loads, tmp_path):
    return shutil.copytree(loads["months"][0], str(tmp_path / "wh"))


def test_whole_run(spark, loads):
    root, metrics = loads["clean"]
    assert all(r["started"][4] == "-" and len(r["started"]) == 19 for r in metrics.collect())
    by_table = {(r["layer"], r["tbl"]): r["rows"] for r in metrics.collect()}
    assert by_table["bronze", "bills"] == 3 and by_table["silver", "rejected_rows"] == 0
    assert by_table["gold", "dim_date"] == 9496
    assert by_table["gold", "fact_billing"] == 2  # the bill without insurance finds no provider
    assert by_table["gold misses", "fact_billing.insurance_id"] == 1
    assert by_table["gold misses", "fact_appointments.doctor_id"] == 0
    assert run.missing_tables(spark, root) == []
    assert {r["layer"] for r in run.step_seconds(metrics).collect()} == {"bronze", "silver", "gold", "quality"}

    found = run.quality_reports(spark, root)
    assert {r["tbl"]: r["rows"] for r in found["row_counts"].collect()}["fact_billing"] == 2
    assert found["several_current_doctors"].isEmpty() and found["date_range_billing"].count() == 1

    published = run.open_quality(spark, root)
    for name, report in found.items():  # the run has published the same result sets
        assert sorted(map(str, published.required(name).collect())) == sorted(map(str, report.collect())), name

    gold = run.gold_tables(spark, root)
    assert rows(gold["fact_billing"].select("bill_id", "billing_key", "recovery_rate").selectExpr(
        "bill_id", "billing_key", "cast(recovery_rate as string)"), "bill_id") == [(1, 1, "100.00"), (2, 2, "37.50")]
    views = reports.create_views(gold)
    monthly = spark.table("vw_monthly_appointments").orderBy("month").collect()
    assert [(r["month_name"], r["total_appointments"], r["no_shows"], str(r["avg_duration_minutes"])) for r in monthly] \
        == [("January", 2, 0, "25.00"), ("February", 1, 1, "15.00")]
    assert views["vw_doctor_performance"].count() == 2


def test_second_run_on_equal_input_changes_only_overwritten_audit_times(spark, clean_load, tmp_path):
    source, root = write_sources(tmp_path / "in"), clean_load
    first = {k: rows(v.drop("dwh_load_date"), v.columns[0]) for k, v in run.gold_tables(spark, root).items()}
    run.run_pipeline(spark, source, root, D2)
    gold = run.gold_tables(spark, root)
    assert {k: rows(v.drop("dwh_load_date"), v.columns[0]) for k, v in gold.items()} == first
    stamps = {k: {r[0] for r in v.select("dwh_load_date").distinct().collect()}
              for k, v in gold.items() if k != "dim_date"}
    assert stamps == {"dim_department": {TS2}, "dim_treatment": {TS2}, "dim_insurance": {TS2}, "dim_patient": {TS1},
                      "dim_doctor": {TS1}, "fact_appointments": {TS1}, "fact_billing": {TS1}}


def test_a_missing_layer_is_named(spark, tmp_path):
    with pytest.raises(LookupError, match="patients has not been published"):
        run.run_silver(spark, str(tmp_path / "wh"), D1, TS1)


def test_changes_reach_history_and_facts(spark, clean_load, tmp_path):
    root = clean_load
    moved = [CLEAN["patients"][0].replace("Rome", "Bari"), CLEAN["patients"][1].replace("Bob", "Rob")]
    visits = [CLEAN["appointments"][0], CLEAN["appointments"][1].replace("2023-01-03", "2023-01-09")
              .replace("Scheduled", "Completed"), "4,1,1,1,1,2023-03-01,12:00,10,Completed,5.00,"]
    run.run_pipeline(spark, write_sources(tmp_path / "b", patients=moved, appointments=visits), root, D2)
    gold = run.gold_tables(spark, root)
    assert rows(gold["dim_patient"].select("patient_key", "patient_id", "first_name", "city", "effective_date",
                                           "end_date", "is_current"), "patient_key") == [
        (1, 1, "Ann", "Rome", D1, D2, False), (2, 2, "Bob", "Oslo", D1, None, True),
        (3, 1, "Ann", "Bari", D2, None, True)]
    assert rows(gold["fact_appointments"].select("appointment_key", "appointment_id", "date_key", "patient_key",
                                                 "appointment_status", "dwh_load_date"), "appointment_key") == [
        (1, 1, 20230102, 1, "Completed", TS1), (2, 2, 20230103, 1, "Completed", TS2),
        (3, 3, 20230201, 2, "No-Show", TS1), (4, 4, 20230301, 3, "Completed", TS2)]


BROKEN = [
    ("appointments", "9,1,1,1,1,2023-01-02,09:00,30,Completed,-1.00,", "fee_not_negative"),
    ("appointments", "9,1,1,1,1,2023-01-02,09:00,0,Completed,1.00,", "duration_positive"),
    ("bills", "9,1,1,1,1,1,2023-01-02,10.00,-5.00,0,0,paid", "covered_not_negative"),
    ("departments", "9,Long,Main," + "x" * 21 + ",Dr. C,1992-01-01", "long_floor"),
    ("patients", "9,Tom,,F,1980-05-01,A+,Rome,Italy,,,2020-01-01,yes", "null_last_name"),
]


def test_broken_constraints_leave_last_run_readable(spark, clean_load, tmp_path):
    root = clean_load
    before = rows(run.gold_tables(spark, root)["fact_appointments"], "appointment_key")
    for i, (table, line, message) in enumerate(BROKEN):
        bad = write_sources(tmp_path / f"b{i}", **{table: [*CLEAN[table], line]})
        with pytest.raises(run.ConstraintError, match=message):
            run.run_pipeline(spark, bad, root, D2)
    assert rows(run.gold_tables(spark, root)["fact_appointments"], "appointment_key") == before
    assert run.open_layer(spark, root, "gold").latest()["version"] == 1


def test_lost_keys_are_found(spark, loads):
    gold = run.gold_tables(spark, loads["clean"][0])
    run.check_integrity(gold)
    with pytest.raises(run.ConstraintError, match="patient_key"):
        run.check_integrity({**gold, "dim_patient": gold["dim_patient"].where("patient_id <> 2")})
    with pytest.raises(run.ConstraintError, match="duplicate department_key"):
        run.check_integrity({**gold, "dim_department": gold["dim_department"].union(gold["dim_department"])})


def test_nothing_published_yet(spark, tmp_path):
    store = run.open_layer(spark, str(tmp_path / "none"), "gold")
    assert store.latest() is None and store.table("dim_date") is None
    assert len(run.missing_tables(spark, str(tmp_path / "none"))) == 8


# Publication by part, retention, key proofs -----------------------------------------------------

def data_files(root, name):
    return {str(p.relative_to(root)) for p in Path(root, "gold").glob(f"run-*/{name}/**/*.parquet")}


def test_a_change_in_one_month_rewrites_that_month_only(spark, months_load, tmp_path):
    root = months_load
    first = run.open_layer(spark, root, "gold")
    before = {p.part: p for p in first.parts("fact_appointments")}
    assert sorted(before) == [202300 + m for m in range(1, 13)] and all(p.rows == 5 for p in before.values())
    files, bills = data_files(root, "fact_appointments"), data_files(root, "fact_billing")
    old = rows(first.table("fact_appointments"), "appointment_key")

    lines = list(MONTHS)
    lines[2] = lines[2].replace("Completed", "Cancelled")  # April
    lines.append("90,1,1,1,1,2023-04-30,09:00,30,Completed,50.00,new")
    run.run_pipeline(spark, write_sources(tmp_path / "b", appointments=lines), root, D2)
    second = run.open_layer(spark, root, "gold")
    after = {p.part: p for p in second.parts("fact_appointments")}
    assert {m for m in after if after[m] != before[m]} == {202304}
    assert after[202304].rows == 6 and after[202304].run != before[202304].run
    added = data_files(root, "fact_appointments") - files
    assert added and all("_part=202304/" in f for f in added)
    assert data_files(root, "fact_billing") == bills  # nothing changed there
    # one version each: the first Store still reads what it opened
    assert rows(first.table("fact_appointments"), "appointment_key") == old
    new = rows(second.table("fact_appointments"), "appointment_key")
    assert len(new) == 61 and [r for r in new if r not in old] == [r for r in new if r[1] in (3, 90)]
    assert new[60][0] == 61 and new[2][8] == "Cancelled" and new[2][-1] == TS2
    run.check_integrity(run.gold_tables(spark, root))


def test_a_month_opens_its_own_files_only(spark, loads, tmp_path):
    root = loads["months"][0]
    april = run.fact_between(spark, root, "fact_appointments", date(2023, 4, 2), date(2023, 4, 30))
    whole = run.gold_tables(spark, root)["fact_appointments"]
    assert 0 < len(april.inputFiles()) < len(whole.inputFiles()) and all("_part=202304" in f for f in april.inputFiles())
    assert rows(april, "appointment_key") == rows(whole.where("date_key BETWEEN 20230402 AND 20230430"), "appointment_key")
    with pytest.raises(LookupError):
        run.fact_between(spark, str(tmp_path / "none"), "fact_billing", D1, D2)


def test_a_stored_fact_is_matched_without_a_shuffle(spark, months_load, tmp_path):
    root = months_load
    run.run_pipeline(spark, write_sources(tmp_path / "b", appointments=MONTHS[:3] + [MONTHS[3].replace("50.00", "51.00")]), root, D2, buckets=5)
    store, clean = run.open_layer(spark, root, "gold"), run.open_layer(spark, root, "silver")
    assert {p.buckets for p in store.parts("fact_appointments")} == {8}  # as the first run dealt them
    assert len({p.run for p in store.parts("fact_appointments")}) == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with store.clustered("fact_appointments") as fact:
            source = G.appointment_source(clean.required("appointments"))
            plan = match(fact, source, "appointment_id", F.lit("keep"))._jdf.queryExecution().executedPlan().toString()
            assert fact.count() == 60
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    before_join, source_side = plan.split("FileScan")[1:3]
    assert plan.count("Exchange hashpartitioning(appointment_id") == 1 and "Bucketed: true" in before_join
    assert "Exchange" not in plan[:plan.index("FileScan")]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("stratalake_")]


def test_a_larger_fact_is_dealt_into_more_files(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    changed = [MONTHS[0].replace("50.00", "60.00"), *MONTHS[1:]]
    for bucket_rows, lines, day, files in ((20, MONTHS, D1, 3), (5, changed, D2, 24), (4, MONTHS, D3, 24)):
        monkeypatch.setattr(run, "BUCKET_ROWS", bucket_rows)
        run.run_pipeline(spark, write_sources(tmp_path / str(day), appointments=lines), root, day, strict=True, buckets=1)
        store = run.open_layer(spark, root, "gold")
        assert {p.buckets for p in store.parts("fact_appointments")} == {files}
        assert {p.buckets for p in store.parts("fact_billing")} == {1}
        stored = rows(store.table("fact_appointments"), "appointment_key")
        assert [r[0] for r in stored] == list(range(1, 61))
        assert [r[10] for r in stored] == [60 if lines is changed else 50] + [50] * 59
    assert len({p.run for p in store.parts("fact_appointments")}) == 2  # all months by the second run, one by the third


def test_retention_spares_leased_runs(spark, months_load, tmp_path):
    root, staged = months_load, set(os.listdir(shared_dir(spark)))
    reader = run.open_layer(spark, root, "gold")
    with reader.lease() as lease:
        assert lease.version == 1
        changed = [MONTHS[0].replace("50.00", "60.00"), *MONTHS[1:]]
        run.run_pipeline(spark, write_sources(tmp_path / "b", appointments=changed), root, D2, keep_runs=1)
        assert rows(reader.table("fact_appointments"), "appointment_key")[0][10] == 50
        assert len(list(Path(root, "bronze").glob("run-*"))) == 1
        assert len(list(Path(root, "gold").glob("run-*"))) == 2
    # version 2 still names the months that version 1 has written
    assert run.retire(spark, root, 1) == [] and rows(run.gold_tables(spark, root)["fact_appointments"], "appointment_key")[0][10] == 60
    bills = [x.rsplit(",", 1)[0] + ",overdue" for x in CLEAN["bills"]]
    run.run_pipeline(spark, write_sources(tmp_path / "c", appointments=[x.replace("50.00", "70.00") for x in MONTHS], bills=bills), root, D3, keep_runs=1)
    assert len(list(Path(root, "gold").glob("run-*"))) == 1
    with pytest.raises(LookupError, match="has been removed"):
        run.open_layer(spark, root, "gold", version=1).lease()
    assert set(os.listdir(shared_dir(spark))) == staged  # no staged folder is left
    with pytest.raises(ValueError):
        run.retire(spark, root, 0)


def test_a_failed_run_leaves_nothing_behind(spark, clean_load, tmp_path):
    root, staged = clean_load, set(os.listdir(shared_dir(spark)))
    before = {layer: {p.name for p in Path(root, layer).glob("run-*")} for layer in run.LAYERS}
    with pytest.raises(run.ConstraintError):
        run.run_pipeline(spark, write_sources(tmp_path / "b", **{BROKEN[0][0]: [*CLEAN[BROKEN[0][0]], BROKEN[0][1]]}), root, D2, keep_runs=3)
    after = {layer: {p.name for p in Path(root, layer).glob("run-*")} for layer in run.LAYERS}
    assert after["gold"] == before["gold"] and len(after["silver"]) == 2  # the fee is a constraint of the fact alone
    assert set(os.listdir(shared_dir(spark))) == staged


def test_keys_are_proven_by_what_was_written(spark, tmp_path):
    store = Store(spark, str(tmp_path), "x", {"t": S.schema("dim_department")}, {"t": Layout("department_key")})

    def proven(i, keys):
        empty = S.empty(spark, "dim_department")
        df = spark.createDataFrame([(k,) for k in keys], "department_key long").join(empty.drop("department_key"), F.lit(True), "left") \
            .select(*empty.columns)
        return dense(spark, {"t": store.write(f"run-{i}", "t", df)[0]})

    assert proven(0, [3, 1, 2]) == {"t"} and proven(1, range(1, 500)) == {"t"} and proven(2, []) == {"t"}
    for i, damaged in enumerate([[1, 1, 3], [1, 2, 2, 4], [2, 3], [0, 1, 2], [1, 3], [1, 2, 3, None], [1, 1, 3, 3, 5], [-1, 1, 3]]):
        assert proven(10 + i, damaged) == set(), damaged


def test_damage_is_found_with_and_without_a_proof(spark, loads):
    root = loads["clean"][0]
    store, gold = run.open_layer(spark, root, "gold"), run.gold_tables(spark, root)
    parts = {name: store.parts(name) for name in S.GOLD_TABLES}
    names = dense(spark, parts)
    assert names == set(S.GOLD_TABLES) - {"dim_date"}
    run.check_integrity(gold, names)
    twice = {**gold, "dim_patient": gold["dim_patient"].union(gold["dim_patient"])}
    with pytest.raises(run.ConstraintError, match="several current versions of one patient_id"):
        run.check_integrity(twice, names)
    with pytest.raises(run.ConstraintError, match="duplicate department_id"):
        run.check_integrity({**gold, "dim_department": gold["dim_department"].withColumn("department_id", F.lit(1))}, names)
    spoilt = parts["fact_billing"][0]._replace(print=7)
    assert "fact_billing" not in dense(spark, {**parts, "fact_billing": [spoilt, *parts["fact_billing"][1:]]})
    with pytest.raises(run.ConstraintError, match="duplicate billing_key"):
        run.check_integrity({**gold, "fact_billing": gold["fact_billing"].union(gold["fact_billing"])}, names - {"fact_billing"})


@pytest.mark.parametrize("ignore_case, versions", [(True, 2), (False, 3)])
def test_letter_case_and_trailing_blanks_may_be_ignored_in_a_run(spark, months_load, tmp_path, ignore_case, versions):
    patients = [x.replace("Rome", "ROME") for x in CLEAN["patients"]]
    visits = [x.replace("Resting", "RESTING") for x in MONTHS]
    run.run_pipeline(spark, write_sources(tmp_path / "b", patients=patients, appointments=visits), months_load, D2, ignore_case=ignore_case)
    gold = run.gold_tables(spark, months_load)
    assert gold["dim_patient"].count() == versions
    stamps = {r["appointment_id"]: r["dwh_load_date"] for r in gold["fact_appointments"].collect()}
    assert stamps[7] == (TS1 if ignore_case else TS2) and stamps[2] == TS1


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while found.hasNext():
        names.add(found.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_a_run_leaves_no_shuffle_files(spark, months_load, tmp_path, monkeypatch):
    before, kept, write = shuffle_files(spark), spark.conf.get(CLEANUP, None), Store.write
    seen = []

    def written(store, run_id, name, *args, **more):
        if store.folder.endswith("quality"):  # the last step: those of the layers before are gone
            for _ in range(50):
                if not shuffle_files(spark) - before:
                    break
                time.sleep(0.2)
            seen.append(shuffle_files(spark) - before)
            return [], {}
        return write(store, run_id, name, *args, **more)

    monkeypatch.setattr(Store, "write", written)
    monkeypatch.setattr(run, "side_by_side", lambda jobs: {name: job() for name, job in jobs.items()})
    run.run_pipeline(spark, write_sources(tmp_path / "b", appointments=[x.replace("50.00", "70.00") for x in MONTHS]), months_load, D2)
    assert seen and seen[0] == set()
    assert spark.conf.get(CLEANUP, None) == kept  # the session is as before
    with pytest.raises(LookupError):
        run.run_silver(spark, str(tmp_path / "none"), D1, TS1)
    assert spark.conf.get(CLEANUP, None) == kept


def test_a_table_is_deduplicated_in_slices_and_what_was_read_goes_at_once(spark, tmp_path, monkeypatch):
    root, shared, staged = str(tmp_path / "wh"), Path(shared_dir(spark)), []
    lines = [*MONTHS, "x,1,1,1,1,2023-01-02,,,,,", "05,1,1,1,1,2024-01-02,09:00,30,Resting,50.00,newest of 5", MONTHS[8], MONTHS[8]]
    monkeypatch.setattr(run, "SLICE_ROWS", 20)
    write = Store.write_slices

    def written(store, run_id, name, slices, counters, done):
        def gone(one):
            done(one)
            staged.append((name, one, {str(p) for p in shared.glob("staging-*/staging-*/staged-*/_verdict=accepted*")}))
        return write(store, run_id, name, slices, counters, gone)

    monkeypatch.setattr(Store, "write_slices", written)
    run.run_bronze(spark, write_sources(tmp_path / "a", appointments=lines), root, TS1)
    run.run_silver(spark, root, D1, TS1)
    visits = [(one, left) for name, one, left in staged if name == "appointments"]
    assert [one for one, _ in visits] == [f"accepted-{i}" for i in range(4)]  # 64 rows
    for i, (one, left) in enumerate(visits):
        assert not [p for p in left for other, _ in visits[:i + 1] if p.endswith(f"={other}")]
    store = run.open_layer(spark, root, "silver")
    found = {r["appointment_id"]: r for r in store.required("appointments").collect()}
    assert len(found) == store.required("appointments").count() == store.parts("appointments")[0].rows == 60
    assert found[5]["notes"] == "newest of 5" and store.required("rejected_rows").count() == 1
    assert not list(shared.glob("staging-*"))

    monkeypatch.setattr(run, "SLICE_ROWS", 1)  # more slices than ids, so some are empty
    run.run_bronze(spark, write_sources(tmp_path / "c", appointments=[MONTHS[0]] * 9 + ["2,1,1,1,1,2023-01-02,09:00,30,,-1.00,"]), root, TS1)
    run.run_silver(spark, root, D1, TS1)
    assert run.open_layer(spark, root, "silver").required("appointments").count() == 2


def test_a_changed_month_joins_the_stored_fact_without_a_shuffle(spark, months_load):
    store = run.open_layer(spark, months_load, "gold")
    april = [p for p in store.parts("fact_appointments") if p.part == 202304]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with store.clustered("fact_appointments", april) as fact:
            ids = spark.range(3, 4).select(F.col("id").cast("int").alias("appointment_id"))
            left = fact.join(ids, "appointment_id", "left_anti")
            plan = left._jdf.queryExecution().executedPlan().toString()
            assert sorted(r["appointment_id"] for r in left.collect()) == [15, 27, 39, 51]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and "Exchange" not in plan[:plan.index("FileScan")]


def test_new_rows_look_up_their_keys_in_slices(spark, months_load, tmp_path, monkeypatch):
    root, lookup_keys, shares = months_load, G.lookup_keys, []
    monkeypatch.setattr(run, "SLICE_ROWS", 20)
    monkeypatch.setattr(G, "lookup_keys", lambda rows, lookups: shares.append(rows.count()) or lookup_keys(rows, lookups))
    lines = [x.replace("50.00", "70.00") for x in MONTHS[:30]] + [x.replace(f"{i},", f"{100 + i},", 1) for i, x in enumerate(MONTHS[:30], 1)]
    lines.append("200,1,9,1,1,2023-01-02,09:00,30,,1.00,no such doctor")
    run.run_pipeline(spark, write_sources(tmp_path / "b", appointments=lines), root, D2, strict=True)
    assert len(shares) == 5 and sum(shares[:4]) == 31 and max(shares[:4]) < 31  # new visits in four slices, bills in one
    stored = rows(run.gold_tables(spark, root)["fact_appointments"], "appointment_key")
    assert [r[:2] for r in stored] == [(i, i) for i in range(1, 61)] + [(60 + i, 100 + i) for i in range(1, 31)]
    assert [r[10] for r in stored] == [70] * 30 + [50] * 60
    run.check_integrity(run.gold_tables(spark, root))


def test_sources_may_be_removed_once_they_are_published(spark, tmp_path):
    root, source = str(tmp_path / "wh"), write_sources(tmp_path / "in", bills=[*CLEAN["bills"], BROKEN[2][1]])
    with pytest.raises(run.ConstraintError):  # of the fact; the raw layer is published
        run.run_pipeline(spark, source, root, D1, consume=True)
    assert not os.path.exists(source) and run.open_layer(spark, root, "bronze").required("bills").count() == 4
    source = write_sources(tmp_path / "kept")
    run.run_pipeline(spark, source, root, D2)
    assert len(os.listdir(source)) == 7


def test_date_forms_of_a_run(spark, tmp_path):
    root = str(tmp_path / "wh")
    run.run_bronze(spark, write_sources(tmp_path / "a", appointments=[CLEAN["appointments"][0].replace("2023-01-02", "02.01.2023")]), root, TS1)
    run.run_silver(spark, root, D1, TS1, formats=("dd.MM.yyyy",))
    assert [r["appointment_date"] for r in run.open_layer(spark, root, "silver").required("appointments").collect()] == [date(2023, 1, 2)]
    run.run_silver(spark, root, D1, TS1)
    silver = run.open_layer(spark, root, "silver")
    assert silver.required("rejected_rows").count() == 1 and silver.required("appointments").isEmpty()


def test_each_raw_table_is_scanned_once(spark, tmp_path):
    from stratalake.plans import silver
    from stratalake.session import Staging

    run.run_bronze(spark, write_sources(tmp_path / "a", appointments=[*CLEAN["appointments"], "x,1,1,1,1,2023-01-02,,,,,"]), str(tmp_path / "wh"), TS1)
    raw = run.open_layer(spark, str(tmp_path / "wh"), "bronze").required("appointments")
    with Staging(spark) as staged:
        good, bad = silver.clean_table("appointments", raw, D1, TS1, staged=staged)
        assert good.count() == 3 and [r["rejection_reason"] for r in bad.collect()] == ["invalid appointment_id"]
        for df in (good, bad):
            assert df.inputFiles() and not any("bronze" in f for f in df.inputFiles())
