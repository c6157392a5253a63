from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stratalake.operators.distinct import key_sets, merged_sets, set_sizes
from stratalake.plans import marts, reports, run
from tests.sources import CLEAN, write_sources

D1, D2 = date(2024, 1, 1), date(2024, 2, 1)
VISITS = [f"{i},{1 + i % 2},{1 + i % 2},{1 + i // 3 % 2},1,2023-{1 + i % 12:02d}-{1 + i % 28:02d},09:00,{'' if i % 5 == 0 else i},"
          f"{('Completed', 'canceled', 'noshow', 'Scheduled', 'Late')[i % 5]},{'' if i % 7 == 0 else f'{i}.55'},ok" for i in range(1, 90)]


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_key_sets_count_like_distinct(spark):
    df = spark.range(0, 200_000, 1, 7).select(
        (F.col("id") % 5).alias("g"), (F.col("id") % 3).alias("h"),
        F.when(F.col("id") % 11 != 0, F.col("id") * 7 % 90_001 + 1).alias("k"), (F.col("id") % 40 + 1).alias("m"))
    sets = key_sets(df, ["g", "h"], {"k": "k", "m": "m"})
    for groups in (["g", "h"], ["g"], ["h"], []):
        expected = df.groupBy(*groups).agg(F.count_distinct("k").alias("ks"), F.count_distinct("m").alias("ms"))
        assert rows(set_sizes(sets, groups, {"k": "ks", "m": "ms"})) == rows(expected)
    assert rows(set_sizes(merged_sets(sets, ["g"]), [], {"k": "n"})) == rows(df.agg(F.count_distinct("k").alias("n")))
    bounds = spark.createDataFrame([(1,), (32768,), (32769,), (1,)], "k long")
    assert set_sizes(key_sets(bounds, [], {"k": "k"}), [], {"k": "n"}).first()[0] == 3
    assert set_sizes(key_sets(bounds.where("k < 0"), [], {"k": "k"}), [], {"k": "n"}).first()[0] == 0


def test_key_sets_hold_no_wide_rows(spark):
    df = spark.range(1_000).select((F.col("id") % 5).alias("g"), (F.col("id") * 40_000 + 1).alias("k"), F.lit(1).alias("m"))
    sets = key_sets(df, ["g"], {"k": "k", "m": "m"})
    assert sets.count() == 1_005 and dict(sets.dtypes)["keys"] == "bigint"
    for made in (sets, set_sizes(sets, ["g"], {"k": "ks", "m": "ms"})):
        assert "SortAggregate" not in made._jdf.queryExecution().executedPlan().toString()
    signs = spark.createDataFrame([(0,), (-1,), (63,), (64,), (-64,), (None,)], "k long")
    assert set_sizes(key_sets(signs, [], {"k": "k"}), [], {"k": "n"}).first()[0] == 5


def test_reports_from_daily_tables(spark, tmp_path):
    root = str(tmp_path / "wh")
    run.run_pipeline(spark, write_sources(tmp_path / "a", appointments=VISITS), root, D1)
    assert marts.refresh(spark, root, datetime(2024, 1, 1)) == [202300 + m for m in range(1, 13)]

    def compare():
        gold, store = run.gold_tables(spark, root), marts.open_marts(spark, root)
        totals, keys = store.table("visit_totals"), store.table("visit_keys")
        monthly = marts.monthly_appointments(totals, keys, gold["dim_date"])
        assert rows(monthly) == rows(reports.monthly_appointments(gold["fact_appointments"], gold["dim_date"]))
        department = marts.department_summary(totals, keys, gold["dim_department"])
        assert rows(department) == rows(reports.department_summary(gold["fact_appointments"], gold["dim_department"]))
        for report in (monthly, department):
            assert "Expand" not in report._jdf.queryExecution().executedPlan().toString()
            assert report.inputFiles() and not any("fact_appointments" in f for f in report.inputFiles())

    compare()
    assert marts.refresh(spark, root, datetime(2024, 1, 2)) == []
    changed = [v.replace("2.55", "3.55") if v.startswith("2,") else v for v in VISITS]  # March
    run.run_pipeline(spark, write_sources(tmp_path / "b", appointments=changed), root, D2)
    assert marts.refresh(spark, root, datetime(2024, 2, 1)) == [202303]
    compare()


def test_daily_tables_of_an_empty_fact(spark, tmp_path):
    root = str(tmp_path / "wh")
    nobody = [v.replace(",1,1,1,", ",9,1,1,") for v in CLEAN["appointments"][:1]]
    run.run_pipeline(spark, write_sources(tmp_path / "a", appointments=nobody), root, D1)
    marts.refresh(spark, root, datetime(2024, 1, 1))
    store, gold = marts.open_marts(spark, root), run.gold_tables(spark, root)
    assert marts.monthly_appointments(store.table("visit_totals"), store.table("visit_keys"), gold["dim_date"]).collect() == []


@pytest.mark.parametrize("name", ["monthly_appointments_marts", "department_summary_marts"])
def test_registered(name):
    from stratalake.star.queries import registered
    assert name in registered()
