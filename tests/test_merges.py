from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratalake.operators.calendar import dim_date
from stratalake.operators.dimensions import history_of_changes, scd1_merge, scd2_merge, version_at
from stratalake.operators.facts import Lookup, fact_upsert, lookup_keys, lookup_misses
from stratalake.operators.keys import assign_keys, highest_key
from stratalake.session import stage

D = [date(2024, 1, i) for i in range(1, 10)]
TS = [datetime(2024, 1, i) for i in range(1, 10)]


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.mark.parametrize("kind, ids", [
    ("int", [5, -2_000_000_000, 2_000_000_000, 0, 262143, 262144, -1]),
    ("bigint", [5, -9_000_000_000_000_000_000, 9_000_000_000_000_000_000, 0, 262143, 262144, -1, 1 << 41, (1 << 41) - 1,
                -(1 << 41), 1 << 60]),
])
def test_keys_follow_the_id_order(spark, kind, ids):
    df = spark.createDataFrame([(i,) for i in ids], f"id {kind}")
    assert rows(assign_keys(df, "id", "key", 10).select("id", "key"), "id") == [
        (v, 11 + i) for i, v in enumerate(sorted(ids))]


def test_a_missing_id_is_refused(spark):
    with pytest.raises(Exception, match="id is NULL"):
        assign_keys(spark.createDataFrame([(1,), (None,), (5,)], "id long"), "id", "key").collect()


def test_keys_of_many_rows_are_dense(spark):
    df = spark.range(0, 3_000_000, 7)
    got = assign_keys(df, "id", "key").agg(F.count("*"), F.min("key"), F.max("key"), F.count_distinct("key"),
                                           F.count_if(F.col("key") != F.col("id") / 7 + 1)).first()
    n = (3_000_000 + 6) // 7
    assert tuple(got) == (n, 1, n, n, 0)


def test_highest_key(spark):
    df = spark.createDataFrame([(3,), (9,)], "key int")
    assert spark.range(1).select(highest_key(df, "key"), highest_key(df.where("key > 10"), "key")).first()[0:2] == (9, 0)


def test_dim_date_keeps_existing_days(spark):
    old = dim_date(spark, D[0], D[2]).withColumn("month_name", F.lit("kept"))
    both = dim_date(spark, D[1], D[4], old)
    assert rows(both.select("date_key", "month_name"), "date_key") == [
        (20240101, "kept"), (20240102, "kept"), (20240103, "kept"), (20240104, "January"), (20240105, "January")]
    assert dim_date(spark, date(2010, 1, 1), date(2035, 12, 31)).agg(
        F.count("*"), F.count_if("is_weekend")).first()[0:2] == (9496, 2714)


def test_overwriting_merge(spark):
    dim = spark.createDataFrame([], "k long, id int, name string, dwh_load_date timestamp")
    first = spark.createDataFrame([(2, "b"), (1, "a")], "id int, name string")
    second = spark.createDataFrame([(1, "A"), (3, None)], "id int, name string")
    dim = scd1_merge(dim, first, "id", ["name"], "k", TS[0])
    dim = scd1_merge(dim, second, "id", ["name"], "k", TS[1])
    assert rows(dim, "k") == [(1, 1, "A", TS[1]), (2, 2, "b", TS[0]), (3, 3, None, TS[1])]


DIM = "k long, id int, name string, city string, dept int, effective_date date, end_date date, is_current boolean, dwh_load_date timestamp"
SNAP = "id int, name string, city string, dept int"
TRACKED = {"city": "", "dept": 0}


def load(spark, dim, day, *snapshot, ignore_case=False):
    snap = spark.createDataFrame(list(snapshot), SNAP)
    return scd2_merge(dim, snap, "id", ["name", "city", "dept"], TRACKED, "k", D[day], TS[day], ignore_case)


def test_history_over_three_loads(spark):
    dim = stage(load(spark, spark.createDataFrame([], DIM), 0,
                     (1, "a", "Rome", 1), (2, "b", None, None), (3, "c", "Oslo", 3), (4, "d", "Bonn", 4)))
    dim = stage(load(spark, dim, 1, (1, "a", "Bari", 1), (2, "B", "", 0), (4, "d", "Bonn", 5)))  # 3 vanishes
    dim = load(spark, dim, 2, (1, "a", "Rome", 1), (2, "b", None, None), (3, "c", "Oslo", 3), (4, "d", "Bonn", 5), (5, "e", None, 1))
    assert rows(dim, "k") == [
        (1, 1, "a", "Rome", 1, D[0], D[1], False, TS[0]),
        (2, 2, "b", None, None, D[0], None, True, TS[0]),  # NULL and blank are the same, name not tracked
        (3, 3, "c", "Oslo", 3, D[0], None, True, TS[0]),  # current throughout
        (4, 4, "d", "Bonn", 4, D[0], D[1], False, TS[0]),
        (5, 1, "a", "Bari", 1, D[1], D[2], False, TS[1]),
        (6, 4, "d", "Bonn", 5, D[1], None, True, TS[1]),
        (7, 1, "a", "Rome", 1, D[2], None, True, TS[2]),
        (8, 5, "e", None, 1, D[2], None, True, TS[2]),
    ]
    assert rows(version_at(dim, F.lit(D[1])).select("id", "city"), "id") == [(1, "Bari"), (2, None), (3, "Oslo"), (4, "Bonn")]


def test_two_changes_on_one_day_leave_a_version_without_length(spark):
    dim = load(spark, spark.createDataFrame([], DIM), 0, (1, "a", "Rome", 1))
    dim = stage(load(spark, stage(dim), 1, (1, "a", "Bari", 1)))
    dim = load(spark, dim, 1, (1, "a", "Oslo", 1))
    assert rows(dim.select("city", "effective_date", "end_date", "is_current"), "k") == [
        ("Rome", D[0], D[1], False), ("Bari", D[1], D[1], False), ("Oslo", D[1], None, True)]
    assert [r["city"] for r in version_at(dim, F.lit(D[1])).collect()] == ["Oslo"]


def test_letter_case_may_be_ignored(spark):
    dim = load(spark, spark.createDataFrame([], DIM), 0, (1, "a", "Rome", 1))
    assert load(spark, dim, 1, (1, "a", "ROME ", 1), ignore_case=True).count() == 1
    assert load(spark, dim, 1, (1, "a", "ROME ", 1)).count() == 2


def test_one_pass_history_equals_repeated_merges(spark):
    daily = [(u, D[d], [None, "", "x", "y"][(u * 7 + d * d) % 4]) for u in range(6) for d in range(5) if (u + d) % 3]
    dim = spark.createDataFrame([], "k long, u int, v string, effective_date date, end_date date, is_current boolean, dwh_load_date timestamp")
    for d in range(5):
        snap = spark.createDataFrame([(u, v) for u, day, v in daily if day == D[d]] or [], "u int, v string")
        dim = stage(scd2_merge(dim, snap, "u", ["v"], {"v": ""}, "k", D[d], TS[d]))
    once = history_of_changes(spark.createDataFrame(daily, "u int, day date, v string"), "u", "day", {"v": ""})
    assert rows(once, "u", "effective_date") == rows(dim.select(*once.columns), "u", "effective_date")


FACT = "fk long, id int, date_key int, pk long, status string, fee decimal(10,2), dwh_load_date timestamp"


def test_fact_upsert_and_misses(spark):
    people = spark.createDataFrame([(1, 10, False), (1, 11, True), (2, 20, True)], "pid int, pk long, is_current boolean")
    days = spark.createDataFrame([(20240101,), (20240102,)], "date_key int")
    lookups = [Lookup(days, "date_key", "date_key", "date_key"), Lookup(people, "pid", "pid", "pk")]
    source = "id int, pid int, date_key int, status string, fee decimal(10,2)"
    mutable = {"status": "", "fee": -1}
    first = spark.createDataFrame([(7, 1, 20240101, "Scheduled", Decimal("5")), (3, 2, 20240102, None, None),
                                   (4, 9, 20240102, "x", None), (5, None, 20240102, "x", None), (6, 1, 19990101, "x", None)], source)
    assert rows(lookup_misses(first, lookups), "lookup") == [("date_key", 1, 1), ("pid", 2, 2)]
    fact = stage(fact_upsert(spark.createDataFrame([], FACT), first, "id", mutable, lookups, "fk", TS[0]))
    assert rows(fact.drop("dwh_load_date"), "fk") == [
        (1, 3, 20240102, 20, None, None), (2, 7, 20240101, 11, "Scheduled", Decimal("5.00"))]
    second = spark.createDataFrame([(7, 2, 20240102, "Completed", Decimal("5")), (3, 2, 20240102, "", Decimal("-1")),
                                    (8, 2, 20240101, "New", Decimal("1"))], source)
    fact = fact_upsert(fact, second, "id", mutable, lookups, "fk", TS[1], staged=stage)
    assert rows(fact, "fk") == [
        (1, 3, 20240102, 20, None, None, TS[0]),  # blank for NULL and -1 for NULL are no change
        (2, 7, 20240101, 11, "Completed", Decimal("5.00"), TS[1]),  # day and person stay as first loaded
        (3, 8, 20240101, 20, "New", Decimal("1.00"), TS[1])]


def test_hot_id_is_split_when_the_dimension_is_too_large_to_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        people = spark.range(5000).select(F.col("id").alias("pid"), (F.col("id") + 1).alias("pk"))
        visits = spark.range(0, 60_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("pid"))
        joined = lookup_keys(visits, [Lookup(people, "pid", "pid", "pk")])
        assert joined.count() == 60_000
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan or "skewJoin=true" in plan


@pytest.fixture
def no_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def watched(plans):
    def staged(df, by=None):
        plans.append(plan_of(df))
        return stage(df, by)
    return staged


def test_each_side_of_a_merge_is_shuffled_once(spark, no_broadcast):
    people = stage(spark.range(200).selectExpr("id + 1 AS k", "cast(id AS int) AS id", "'n' AS name", "'Rome' AS city", "1 AS dept",
                                               "date'2024-01-01' AS effective_date", "cast(NULL AS date) AS end_date",
                                               "true AS is_current", "timestamp'2024-01-01' AS dwh_load_date"))
    snapshot = stage(spark.range(100, 300).selectExpr("cast(id AS int) AS id", "'n' AS name", "if(id % 2 = 0, 'Bari', 'Rome') AS city", "1 AS dept"))
    fact = stage(spark.range(200).selectExpr("id + 1 AS fk", "cast(id AS int) AS id", "20240101 AS date_key", "5L AS pk", "'x' AS status",
                                             "cast(1 AS decimal(10,2)) AS fee", "timestamp'2024-01-01' AS dwh_load_date"))
    visits = stage(spark.range(100, 300).selectExpr("cast(id AS int) AS id", "1 AS pid", "20240101 AS date_key", "'y' AS status",
                                                    "cast(1 AS decimal(10,2)) AS fee"))
    lookups = [Lookup(spark.createDataFrame([(1, 5)], "pid int, pk long"), "pid", "pid", "pk")]
    merges = {
        "scd1": lambda staged: scd1_merge(people.select("k", "id", "name", "dwh_load_date"), snapshot.select("id", "name"), "id", ["name"], "k", TS[1], staged),
        "scd2": lambda staged: scd2_merge(people, snapshot, "id", ["name", "city", "dept"], TRACKED, "k", D[1], TS[1], staged=staged),
        "fact": lambda staged: fact_upsert(fact, visits, "id", {"status": "", "fee": -1}, lookups, "fk", TS[1], staged=staged),
    }
    for name, merge in merges.items():
        plans = []
        rows = merge(watched(plans))
        assert plans[0].count("Exchange hashpartitioning") == 2 and plans[0].count("FullOuter") == 1, name
        assert plans[0].count("FileScan") == 2, name
        assert "FullOuter" not in plan_of(rows) and not any("FullOuter" in p for p in plans[1:]), name
        assert rows.count() == {"scd1": 300, "scd2": 350, "fact": 300}[name]


def test_merging_into_nothing_needs_no_join(spark):
    plans = []
    snapshot = stage(spark.range(50).selectExpr("cast(id AS int) AS id", "'n' AS name", "'Rome' AS city", "1 AS dept"))
    rows = scd2_merge(spark.createDataFrame([], DIM).limit(0), snapshot, "id", ["name", "city", "dept"], TRACKED, "k", D[0], TS[0],
                      staged=watched(plans))
    assert "Join" not in plans[0] and "Exchange" not in plans[0] and rows.count() == 50


def test_repeated_and_missing_ids_of_a_source_are_not_lost(spark):
    """NULL ids meet nothing; they reach key assignment, which refuses them."""
    dim = spark.createDataFrame([(1, 1, "a", TS[0])], "k long, id int, name string, dwh_load_date timestamp")
    with pytest.raises(Exception, match="id is NULL"):
        scd1_merge(dim, spark.createDataFrame([(None, "x")], "id int, name string"), "id", ["name"], "k", TS[1]).collect()


def test_staged_keys_are_read_again_without_ranking(spark):
    df = spark.createDataFrame([(i,) for i in [5, -1, 262144, 1 << 41, 0]], "id long")
    keyed = assign_keys(df, "id", "key", 10, stage)
    assert rows(keyed.select("id", "key"), "id") == rows(assign_keys(df, "id", "key", 10).select("id", "key"), "id")
    assert "Window" not in keyed._jdf.queryExecution().executedPlan().toString()


def test_a_write_by_folder_needs_no_sort(spark):
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, "0")
    try:
        seen = []
        df = spark.range(4).selectExpr("id", "if(id % 2 = 0, 'a', 'b') AS side", "spark_partition_id() AS _p")

        class Conf:  # notes the setting at the time of the write
            def __getattr__(self, name):
                if name == "write":
                    seen.append(spark.conf.get(writers))
                return getattr(df, name)

        written = stage(Conf(), "side")
        assert seen == ["8"] and spark.conf.get(writers) == "0"
        assert rows(written.select("id", "side"), "id") == [(0, "a"), (1, "b"), (2, "a"), (3, "b")]
    finally:
        spark.conf.set(writers, before)
