"""Raw files to published star schema, layer by layer (PIPE-1, PIPE-2, SNK-3, SRC-6, CON-1..6)."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack, nullcontext
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake import schemas as S
from stratalake.functions.casts import DATE_FORMATS
from stratalake.operators import checks
from stratalake.operators.cleaning import VERDICT
from stratalake.operators.facts import lookup_misses
from stratalake.plans import gold as G
from stratalake.plans import quality, silver
from stratalake.session import Staging, delete, shuffles_removed
from stratalake.sources.delimited import load_bronze
from stratalake.sources.snapshots import Layout, Part, Store, dense

METRICS = "layer string, tbl string, rows long, started string, seconds double"
DIMENSIONS = ("dim_date", "dim_department", "dim_treatment", "dim_insurance", "dim_patient", "dim_doctor")
FACTS = ("fact_appointments", "fact_billing")
LAYERS = ("bronze", "silver", "gold")
# Facts lie in a folder per month, so a run rewrites only the months it changes; inside, rows are dealt by business id.
_MONTH = "date_key div 100"
LAYOUTS = {
    "dim_department": Layout("department_key"), "dim_treatment": Layout("treatment_key"), "dim_insurance": Layout("insurance_key"),
    "dim_patient": Layout("patient_key"), "dim_doctor": Layout("doctor_key"),
    "fact_appointments": Layout("appointment_key", _MONTH, "appointment_id", "date_key"),
    "fact_billing": Layout("billing_key", _MONTH, "bill_id", "date_key"),
}
BUCKET_ROWS = 1 << 20  # of a fact, for each of the files that a month is dealt into
SLICE_ROWS, SLICES = 1 << 20, 6  # least rows and most number of the slices in which large tables are shuffled
MISSES = "gold misses"  # metrics rows of cleaned rows that a fact lacks


class ConstraintError(Exception):
    """A table breaks its declared constraints; nothing of the run was published."""


class QualityError(Exception):
    """Raised in strict mode when a quality counter is not zero."""


class _Layer:
    """Writes one run of one layer and publishes it only if every table passed. Shuffle files of its queries go as each ends."""

    def __init__(self, store: Store, layer: str, load_ts: datetime):
        self.store, self.layer, self.load_ts, self._open = store, layer, load_ts, ExitStack()
        self.run = f"run-{load_ts:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"
        self.tables: dict[str, list[Part]] = {}
        self.metrics: list[tuple] = []

    def write(self, name: str, df: DataFrame | Mapping[str, DataFrame], counters: dict | None = None, write: Callable | None = None) -> DataFrame:
        """Write a table, check the counters taken on the way and return it as written."""
        started, clock = datetime.now(), time.monotonic()
        parts, seen = (write or self.store.write)(self.run, name, df, counters)
        self.note(name, parts, started, clock)
        broken = {check: n for check, n in seen.items() if n}
        if broken:
            raise ConstraintError(f"{self.layer}.{name}: {broken}")
        return self.store.read(name, parts)

    def note(self, name: str, parts: list[Part], started: datetime, clock: float) -> None:
        self.tables[name] = parts
        self.metrics.append((self.layer, name, sum(p.rows for p in parts), f"{started:%Y-%m-%d %H:%M:%S}", time.monotonic() - clock))

    def write_all(self, jobs: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
        """Write independent tables side by side, so that one table's last tasks do not leave the
        cluster idle. Raises the first failure in order."""
        return side_by_side(jobs)

    def publish(self) -> list[tuple]:
        self.store.publish(self.run, self.tables, self.load_ts)
        order = list(self.store.schemas)
        return sorted(self.metrics, key=lambda row: order.index(row[1]))

    def __enter__(self) -> _Layer:
        self._open.enter_context(shuffles_removed(self.store.spark))
        return self

    def __exit__(self, failure, *_) -> None:
        with self._open:
            if failure is not None:
                self.store.abandon(self.run)


def side_by_side(jobs: Mapping[str, Callable]) -> dict:
    """The results of some driver-side calls that each run Spark jobs; the first failure in order is raised when
    all have ended, so nothing is still being written then."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
    return {name: job.result() for name, job in running.items()}


def open_layer(spark: SparkSession, root: str, layer: str, id_type: str = "int", version: int | None = None) -> Store:
    return Store(spark, root, layer, S.layer_schemas(layer, id_type), LAYOUTS if layer == "gold" else None, version)


def _constraints(name: str) -> dict:
    """Counters that must be zero on a stored table: required columns, text lengths, value conditions."""
    return {**checks.null_counters(S.required(name)), **checks.length_counters(S.lengths(name)),
            **checks.failure_counters(G.fact_conditions(name))}


def run_bronze(spark: SparkSession, source_dir: str, root: str, load_ts: datetime) -> list[tuple]:
    with _Layer(open_layer(spark, root, "bronze"), "bronze", load_ts) as layer:
        layer.write_all({name: lambda df=df, name=name: layer.write(name, df)
                         for name, df in load_bronze(spark, source_dir, load_ts).items()})
        return layer.publish()


def run_silver(spark: SparkSession, root: str, as_of: date, load_ts: datetime, id_type: str = "int",
               formats: Sequence[str] = DATE_FORMATS) -> list[tuple]:
    """Each raw table is read once: its rows are written by verdict, and both results come from there."""
    bronze = open_layer(spark, root, "bronze")
    with _Layer(open_layer(spark, root, "silver", id_type), "silver", load_ts) as layer, Staging(spark) as staged:
        def clean(name: str) -> DataFrame:
            judged, slices = staged.inner(), slices_of(sum(p.rows for p in bronze.parts(name)))
            good, bad = silver.clean_slices(name, bronze.required(name), as_of, load_ts, id_type, formats, judged, slices)
            done = partial(judged.remove, VERDICT)  # the rejected ones are read at the end
            layer.write(name, good, _constraints(name), partial(layer.store.write_slices, done=done))
            return bad

        rejected = layer.write_all({name: lambda name=name: clean(name) for name in S.BRONZE_TABLES})
        layer.write("rejected_rows", silver.reject_log(rejected), _constraints("rejected_rows"))
        return layer.publish()


def slices_of(rows: int) -> int:
    """Slices in which a table of so many rows is deduplicated, or looks up its keys, one after another."""
    return min(SLICES, 1 + rows // SLICE_ROWS)


def run_gold(spark: SparkSession, root: str, as_of: date, load_ts: datetime, id_type: str = "int",
             first_day: date = G.FIRST_DAY, last_day: date = G.LAST_DAY, ignore_case: bool = False,
             buckets: int = 8) -> list[tuple]:
    """All dimensions, then both facts, which look up the dimensions as the run has written them.

    ``buckets`` is the least number of files of each month of a fact, and so of the tasks that match a fact with its
    source. The first run takes more of them for a larger source; the number then stays until the fact or a source
    has outgrown it twice over, when all months are dealt anew.
    """
    with _Layer(open_layer(spark, root, "gold", id_type), "gold", load_ts) as layer, Staging(spark) as staged:
        run = G.Run(spark, as_of, load_ts, id_type, first_day, last_day, ignore_case, staged)
        clean = open_layer(spark, root, "silver", id_type)

        def old(name: str) -> DataFrame:
            published = layer.store.table(name)
            return S.empty(spark, name, id_type) if published is None else published

        def highest(name: str) -> int:
            return max((p.high or 0 for p in layer.store.parts(name)), default=0)

        def dimension(name: str) -> DataFrame:
            with staged.inner() as mine:
                if name == "dim_date":
                    df = G.load_dates(run, old(name))
                else:
                    source, tracked = G.DIMENSIONS[name]
                    more = () if tracked is None else (tracked,)
                    df = (G.load_overwritten if tracked is None else G.load_versioned)(
                        run._replace(staged=mine), old(name), clean.required(source), *more, highest(name))
                return layer.write(name, S.conform(df, name, id_type), _constraints(name))

        def fact(name: str) -> DataFrame:
            load = G.fact_load(name, clean.required(G.FACTS[name]), tables)
            started, clock = datetime.now(), time.monotonic()
            parts = layer.store.parts(name)
            dealt = next((p.buckets for p in parts), 0)
            coming = sum(p.rows for p in clean.parts(G.FACTS[name]))
            files = files_of(dealt, sum(p.rows for p in parts), coming, buckets)
            anew = files != dealt
            with staged.inner() as mine:
                with nullcontext(old(name)) if anew else layer.store.clustered(name) as stored:
                    delta = G.fact_delta(run._replace(staged=mine), name, stored, load, highest(name), slices_of(coming))
                months = [r[0] for r in delta.select(F.expr(LAYOUTS[name].divide_by).cast("int")).distinct().collect()]  # days of dim_date
                if not months:  # all parts stay
                    layer.note(name, parts, started, clock)
                    return layer.store.read(name, parts)
                parts = [p for p in parts if anew or p.part in months]
                with nullcontext(layer.store.read(name, parts)) if anew or not parts else layer.store.clustered(name, parts) as touched:
                    rows = touched.join(delta.select(load.id_col), load.id_col, "left_anti").select(*delta.columns).unionByName(delta)
                    return layer.write(name, S.conform(rows, name, id_type), _constraints(name), partial(layer.store.write_parts, buckets=files, anew=anew))

        tables: dict[str, DataFrame] = {}
        tables.update(layer.write_all({n: partial(dimension, n) for n in DIMENSIONS}))
        for name in FACTS:  # one after the other: each shuffles its source and its months
            tables[name] = fact(name)
        check_integrity(tables, dense(spark, layer.tables))
        misses = fact_misses(clean, tables)
        return layer.publish() + misses


def files_of(dealt: int, stored: int, source: int, least: int) -> int:
    """Files of each month of a fact of ``stored`` rows, now in ``dealt`` files, for a load of ``source`` rows."""
    if dealt and max(stored, source) <= 2 * dealt * BUCKET_ROWS:
        return dealt
    return max(least, dealt, -(-(stored + source) // BUCKET_ROWS))


def fact_misses(clean: Store, gold: dict[str, DataFrame]) -> list[tuple]:
    """One metrics row per fact and look-up: cleaned rows that no dimension row fits and the fact lacks."""
    def count(name: str) -> list[tuple]:
        load = G.fact_load(name, clean.required(G.FACTS[name]), gold)
        started, clock = datetime.now(), time.monotonic()
        rows = lookup_misses(load.source, load.lookups).collect()  # one row per look-up
        seconds = time.monotonic() - clock
        return [(MISSES, f"{name}.{r['lookup']}", r["missing_rows"], f"{started:%Y-%m-%d %H:%M:%S}", seconds) for r in rows]

    found = side_by_side({name: partial(count, name) for name in FACTS})
    return [row for name in FACTS for row in found[name]]


def check_integrity(gold: dict[str, DataFrame], proven: Collection[str] = ()) -> None:
    """Primary, unique and foreign keys of all gold tables; raises on the first that is broken.

    The generated keys of ``proven`` tables are known to be unique, so only business ids and the keys of
    other tables are grouped. At most three queries run, side by side.
    """
    unique = {name: [] if name in proven else [S.columns(name)[0]] for name in S.GOLD_TABLES}
    for name in ("dim_department", "dim_treatment", "dim_insurance"):
        unique[name].append(S.columns(name)[1])

    def repeated() -> list:
        found = [checks.duplicates(gold[name], key).select(F.lit(f"{name}: duplicate {key}").alias("broken"))
                 for name, keys in unique.items() for key in keys]
        found += [quality.several_current(gold[name], key).select(F.lit(f"{name}: several current versions of one {key}").alias("broken"))
                  for name, key in (("dim_patient", "patient_id"), ("dim_doctor", "doctor_id"))]
        return [r["broken"] for r in reduce(DataFrame.unionByName, found).distinct().collect()]  # a row per check

    def lost(name: str) -> list:
        lookups = G.fact_lookups(name, gold)
        by_key = [look._replace(on=look.key_col) for look in lookups]
        return [tuple(r) for r in checks.orphans(gold[name], by_key).where("violations > 0").collect()]

    found = side_by_side({"keys": repeated, **{name: partial(lost, name) for name in FACTS}})
    if found["keys"]:
        raise ConstraintError(f"gold.{', '.join(sorted(found['keys']))}")
    for name in FACTS:
        if found[name]:
            raise ConstraintError(f"gold.{name}: unknown keys {found[name]}")


def fact_between(spark: SparkSession, root: str, name: str, first_day: date, last_day: date, id_type: str = "int") -> DataFrame:
    """The rows of a fact from ``first_day`` to ``last_day``; only the files of those months are opened."""
    first, last = (day.year * 10000 + day.month * 100 + day.day for day in (first_day, last_day))
    found = open_layer(spark, root, "gold", id_type).table(name, first // 100, last // 100)
    if found is None:
        raise LookupError(f"{root}/gold: table {name} has not been published")
    return found.where(F.col("date_key").between(first, last))


def gold_tables(spark: SparkSession, root: str, id_type: str = "int") -> dict[str, DataFrame]:
    store = open_layer(spark, root, "gold", id_type)
    return {name: store.table(name) for name in S.GOLD_TABLES}


def missing_tables(spark: SparkSession, root: str) -> list[str]:
    """Expected gold tables that the newest run does not hold (DQ-8)."""
    entry = open_layer(spark, root, "gold").latest()
    published = set() if entry is None else set(entry["tables"])
    return [name for name in S.GOLD_TABLES if name not in published]


def quality_reports(spark: SparkSession, root: str, id_type: str = "int") -> dict[str, DataFrame]:
    """The result sets of the quality step over the newest run: row counts, NULL keys, invalid rows,
    ids with several current versions, first and last days."""
    return quality.quality_reports(gold_tables(spark, root, id_type))


def run_quality(spark: SparkSession, root: str, strict: bool = False, id_type: str = "int", load_ts: datetime | None = None) -> list[tuple]:
    """Publish the result sets of the quality step and count violations; only ``strict`` turns them into an error."""
    started, clock = datetime.now(), time.monotonic()
    gold = gold_tables(spark, root, id_type)
    with _Layer(open_quality(spark, root), "quality", load_ts or started) as layer:
        def report(name: str, df: DataFrame) -> Callable[[], object]:
            columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in layer.store.schemas[name]]
            return partial(layer.write, name, df.select(*columns))

        jobs = {name: report(name, df) for name, df in quality.quality_reports(gold).items()}
        found = side_by_side({**jobs, "violations": quality.violations(gold).collect})["violations"]
        layer.publish()
    seconds = time.monotonic() - clock
    if strict and any(r["violations"] for r in found):
        raise QualityError(str({r["check_name"]: r["violations"] for r in found if r["violations"]}))
    return [("quality", r["check_name"], r["violations"], f"{started:%Y-%m-%d %H:%M:%S}", seconds) for r in found]


def open_quality(spark: SparkSession, root: str) -> Store:
    """The result sets of the newest quality step, a table each."""
    return Store(spark, root, "quality", {name: T.StructType.fromDDL(ddl) for name, ddl in quality.REPORTS.items()})


def retire(spark: SparkSession, root: str, keep_runs: int) -> list[str]:
    """Remove runs of all layers that are older than the newest ``keep_runs`` and that no reader has leased."""
    stores = [*(open_layer(spark, root, layer) for layer in LAYERS), open_quality(spark, root)]
    return [folder for store in stores for folder in store.retire(keep_runs)]


def run_pipeline(spark: SparkSession, source_dir: str, root: str, as_of: date, load_ts: datetime | None = None,
                 strict: bool = False, id_type: str = "int", first_day: date = G.FIRST_DAY,
                 last_day: date = G.LAST_DAY, ignore_case: bool = False, formats: Sequence[str] = DATE_FORMATS,
                 keep_runs: int | None = None, buckets: int = 8, consume: bool = False) -> DataFrame:
    """All four steps in order; the first failure stops the run. Returns one metrics row per table.

    With ``keep_runs``, older runs that no reader has leased are removed at the end, also after a failure. With
    ``consume``, the source folder is removed once its rows are published as the raw layer.
    """
    load_ts = load_ts or datetime.combine(as_of, datetime.min.time())
    try:
        metrics = run_bronze(spark, source_dir, root, load_ts)
        if consume:
            delete(spark, source_dir)
        metrics += run_silver(spark, root, as_of, load_ts, id_type, formats)
        metrics += run_gold(spark, root, as_of, load_ts, id_type, first_day, last_day, ignore_case, buckets)
        metrics += run_quality(spark, root, strict, id_type, load_ts)
    finally:
        if keep_runs is not None:
            retire(spark, root, keep_runs)
    return spark.createDataFrame(metrics, METRICS)


def step_seconds(metrics: DataFrame) -> DataFrame:
    """Elapsed seconds and rows per layer; quality rows share one measurement."""
    return metrics.where(F.col("layer") != MISSES).groupBy("layer").agg(
        F.min("started").alias("started"),
        F.when(F.col("layer") == "quality", F.max("seconds")).otherwise(F.sum("seconds")).alias("seconds"),
        F.sum("rows").alias("rows"),
    )
