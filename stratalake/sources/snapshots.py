"""All-or-nothing publication of a set of tables (SNK-3, SRC-5, SRC-7).

Every run writes to folders of its own. The layer's tables change only when one row is appended to the layer's
log, and Spark makes that one file visible by a single rename; a run that fails before leaves the last
published run in place. The row names the folder of every table, and of every part of a table that is divided: parts
that a run did not touch are carried on by naming the folder of the run that wrote them. One writer at a time
is a precondition.

Rows and generated keys of each part are counted and fingerprinted where it is written, so the log also proves which
keys were given (``dense``). Old runs are removed by ``retire``, which spares what a lease names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from stratalake.session import COMPRESSION, delete, exists, folders

LOG = ("version long, run string, published_at timestamp, tables map<string, long>, "
       "parts array<struct<tbl: string, part: int, run: string, rows: long, low: long, high: long, print: long, buckets: int>>")
PART = "_part"
LEASE = "version long, until timestamp"


class Layout(NamedTuple):
    """How a table lies on disk. ``key`` is its generated key, if it has one. With ``divide_by`` the table has a folder
    per value of that whole number, and in each the rows are dealt by ``cluster_by`` into a fixed number of files."""

    key: str | None = None
    divide_by: str | None = None  # a SQL expression
    cluster_by: str | None = None
    sort_by: str | None = None


class Part(NamedTuple):
    """A table, or one part of it, as a run has written it: rows, the range of its keys and their fingerprint."""

    tbl: str
    part: int | None
    run: str
    rows: int
    low: int | None = None
    high: int | None = None
    print: int | None = None
    buckets: int | None = None


def key_measures(key: str | None) -> dict[str, Column]:
    """Rows, range and order-free fingerprint of the keys; aggregates."""
    number = F.lit(None).cast("long") if key is None else F.col(key).cast("long")
    return {"rows": F.count(F.lit(1)), "low": F.min(number), "high": F.max(number), "print": F.bit_xor(F.when(number.isNotNull(), F.xxhash64(number)))}


class Store:
    """One layer's published tables under ``root``.

    The newest run (or the ``version`` asked for) is looked up once, so all tables read through one Store belong
    together even if another run is published meanwhile.
    """

    def __init__(self, spark: SparkSession, root: str, layer: str, schemas: Mapping[str, StructType],
                 layouts: Mapping[str, Layout] | None = None, version: int | None = None):
        self.spark, self.folder, self.schemas = spark, f"{root.rstrip('/')}/{layer}", schemas
        self.layouts, self.version = layouts or {}, version
        self._entry: list = []

    def log(self) -> DataFrame:
        """One row per published run, with the row count of each of its tables and the folders they lie in."""
        if not exists(self.spark, f"{self.folder}/log"):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).json(f"{self.folder}/log")

    def latest(self):
        """The log row that this Store reads: the newest run's, or None."""
        if not self._entry:
            log = self.log() if self.version is None else self.log().where(F.col("version") == self.version)
            self._entry = log.orderBy(F.desc("version")).take(1) or [None]
        return self._entry[0]

    def parts(self, name: str) -> list[Part]:
        """The folders that make up a table; none if it is not published or is divided and has no rows."""
        entry = self.latest()
        if entry is None or name not in entry["tables"]:
            return []
        return [Part(**p.asDict()) for p in entry["parts"] if p["tbl"] == name]

    def table(self, name: str, first: int | None = None, last: int | None = None) -> DataFrame | None:
        """A table of the newest run, or None where there is none. Of a divided table, only the parts from ``first`` to
        ``last`` are opened."""
        entry = self.latest()
        if entry is None or name not in entry["tables"]:
            return None
        wanted = [p for p in self.parts(name) if p.part is None or (first is None or p.part >= first) and (last is None or p.part <= last)]
        return self.read(name, wanted)

    def read(self, name: str, parts: Sequence[Part]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schemas[name]).limit(0)  # the limit tells Spark that there are no rows
        return self.spark.read.schema(self.schemas[name]).parquet(*[self._path(p) for p in parts])

    def required(self, name: str) -> DataFrame:
        """A table of the newest run; an error that names it where there is none."""
        found = self.table(name)
        if found is None:
            raise LookupError(f"{self.folder}: table {name} has not been published")
        return found

    def _path(self, part: Part) -> str:
        folder = f"{self.folder}/{part.run}/{part.tbl}"
        return folder if part.part is None else f"{folder}/{PART}={part.part}"

    @contextmanager
    def clustered(self, name: str, parts: Sequence[Part] | None = None) -> Iterator[DataFrame]:
        """A divided table, or some parts of it, as Spark's bucketed table, whose rows need no shuffle to be joined or grouped by
        ``cluster_by``. Its definition lives in the session's catalog for the length of the block."""
        parts, layout, schema = self.parts(name) if parts is None else parts, self.layouts[name], self.schemas[name]
        table = f"stratalake_{uuid.uuid4().hex}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE {table} ({columns}, {PART} int) USING parquet PARTITIONED BY ({PART}) CLUSTERED BY "
                       f"({layout.cluster_by}) INTO {parts[0].buckets} BUCKETS LOCATION '{self.folder}/{table}'")
        try:
            self.spark.sql(f"ALTER TABLE {table} ADD " + " ".join(
                f"PARTITION ({PART}={p.part}) LOCATION '{self._path(p)}'" for p in parts))
            yield self.spark.table(table).select(*schema.names)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: files stay

    def write(self, run: str, name: str, df: DataFrame, counters: Mapping[str, Column] | None = None) -> tuple[list[Part], dict[str, int]]:
        """Write a whole table of a run; its parts, and its ``counters``, which come from the same pass.

        The counters sit right below the write, in the tasks whose results count only once.
        """
        df, seen = self._observed(name, df, {**key_measures(self.layouts.get(name, Layout()).key), **(counters or {})})
        folder = f"{self.folder}/{run}/{name}"
        df.write.mode("errorifexists").option("compression", COMPRESSION).parquet(folder)
        found = self._counted(seen, name, folder, ["rows", *(counters or {})], ["low", "high", "print"])
        part = Part(name, None, run, *(found.pop(m) for m in ("rows", "low", "high", "print")))
        return [part], found

    def write_slices(self, run: str, name: str, slices: Mapping[str, DataFrame], counters: Mapping[str, Column] | None = None,
                     done: Callable[[str], object] = lambda _: None) -> tuple[list[Part], dict[str, int]]:
        """Write a whole table without a generated key that comes in slices, one after another, so that only one slice
        is shuffled at a time; ``done`` hears of each slice that is written."""
        folder, counts = f"{self.folder}/{run}/{name}", ["rows", *(counters or {})]
        if exists(self.spark, folder):
            raise FileExistsError(folder)
        total = dict.fromkeys(counts, 0)
        for one, rows in slices.items():
            df, seen = self._observed(name, rows, {"rows": F.count(F.lit(1)), **(counters or {})})
            df.write.mode("append").option("compression", COMPRESSION).parquet(folder)
            found = self._counted(seen, name, folder, counts, before=total["rows"])
            total = {c: total[c] + found[c] for c in counts}
            done(one)
        return [Part(name, None, run, total.pop("rows"))], total

    def write_parts(self, run: str, name: str, df: DataFrame, counters: Mapping[str, Column] | None = None,
                    buckets: int = 8, anew: bool = False) -> tuple[list[Part], dict[str, int]]:
        """Write the parts of a divided table that ``df`` has rows of, whole, and carry on all others.

        The number of files a part is dealt into stays that of the run before, since parts of several runs are joined
        together; with ``anew``, ``df`` is the whole table and all parts are dealt into ``buckets``. Rows and keys are counted per part from the written files, of which only two columns are read.
        """
        layout, before = self.layouts[name], {} if anew else {p.part: p for p in self.parts(name)}
        buckets = next((p.buckets for p in before.values()), buckets)
        df, seen = self._observed(name, df, {"rows": F.count(F.lit(1)), **(counters or {})})
        folder, table = f"{self.folder}/{run}/{name}", f"stratalake_{uuid.uuid4().hex}"
        rows = df.withColumn(PART, F.expr(layout.divide_by).cast("int")).repartition(buckets, layout.cluster_by)
        rows.sortWithinPartitions(PART, layout.sort_by).write.partitionBy(PART).bucketBy(buckets, layout.cluster_by).format("parquet").options(
            path=folder, compression=COMPRESSION).saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")
        written = self.spark.read.schema(StructType([*self.schemas[name].fields, StructField(PART, IntegerType())])).parquet(folder)
        counts = written.groupBy(PART).agg(*[c.alias(m) for m, c in key_measures(layout.key).items()]).collect()  # a row per part
        before |= {r[PART]: Part(name, r[PART], run, r["rows"], r["low"], r["high"], r["print"], buckets) for r in counts}
        found = self._counted(seen, name, folder, ["rows", *(counters or {})])
        if found.pop("rows") != sum(r["rows"] for r in counts):
            raise OSError(f"{folder}: rows are missing")
        return [before[p] for p in sorted(before)], found

    def _observed(self, name: str, df: DataFrame, measures: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        return df.observe(seen, *[c.alias(k) for k, c in measures.items()]), seen

    def _counted(self, seen: Observation, name: str, folder: str, counts: Sequence[str], others: Sequence[str] = (), before: int = 0) -> dict:
        """The counters of a write into a folder that held so many rows ``before``."""
        try:
            return seen.get
        except Py4JJavaError:  # Spark gives no counters for a plan that turns out to have no rows
            if self.spark.read.schema(self.schemas[name]).parquet(folder).count() != before:
                raise
            return {**dict.fromkeys(counts, 0), **dict.fromkeys(others)}

    def publish(self, run: str, tables: Mapping[str, Sequence[Part]], at: datetime) -> int:
        """Make a fully written run the current one."""
        entry = self.latest()
        version = 1 if entry is None else entry["version"] + 1
        counts = {name: sum(p.rows for p in parts) for name, parts in tables.items()}
        row = self.spark.createDataFrame([(version, run, at, counts, [tuple(p) for parts in tables.values() for p in parts])], LOG)
        row.coalesce(1).write.mode("append").json(f"{self.folder}/log")
        self._entry = []
        return version

    # Retention

    def lease(self, hours: float = 24) -> Lease:
        """Keeps the run that this Store reads from being removed, until it is released or the time is over."""
        entry = self.latest()
        if entry is None:
            raise LookupError(f"{self.folder}: nothing has been published")
        path = f"{self.folder}/leases/{uuid.uuid4().hex}"
        until = datetime.now() + timedelta(hours=hours)
        self.spark.createDataFrame([(entry["version"], until)], LEASE).coalesce(1).write.json(path)
        lease = Lease(self.spark, path, entry["version"])
        if not all(exists(self.spark, self._path(p)) for t in entry["tables"] for p in self.parts(t)):
            lease.release()
            raise LookupError(f"{self.folder}: version {entry['version']} has been removed")
        return lease

    def leased(self) -> set[int]:
        """Versions with a lease that is not over."""
        paths = folders(self.spark, f"{self.folder}/leases")
        if not paths:
            return set()
        held = self.spark.read.schema(LEASE).json(paths).where(F.col("until") > F.lit(datetime.now()))
        return {r["version"] for r in held.collect()}

    def retire(self, keep_runs: int) -> list[str]:
        """Remove the folders of runs that neither the newest ``keep_runs`` versions nor leased ones name, runs that were
        never published among them. Returns the removed folders."""
        if keep_runs < 1:
            raise ValueError("at least one run stays")
        log = self.log().select("version", "run", F.transform("parts", lambda p: p["run"]).alias("runs")).collect()  # a row per run
        newest = {r["version"] for r in sorted(log, key=lambda r: -r["version"])[:keep_runs]} | self.leased()
        needed = {run for r in log if r["version"] in newest for run in [r["run"], *(r["runs"] or [])]}
        gone = [f for f in folders(self.spark, self.folder) if f.rsplit("/", 1)[1].startswith("run-") and f.rsplit("/", 1)[1] not in needed]
        for folder in gone:
            delete(self.spark, folder)
        return gone

    def abandon(self, run: str) -> None:
        """Remove what an unpublished run has written."""
        if not self.log().where(F.col("run") == run).isEmpty():
            raise ValueError(f"{run} is published")
        delete(self.spark, f"{self.folder}/{run}")


class Lease:
    """A reader's hold on one version; a context manager."""

    def __init__(self, spark: SparkSession, path: str, version: int):
        self.spark, self.path, self.version = spark, path, version

    def release(self) -> None:
        delete(self.spark, self.path)

    def __enter__(self) -> Lease:
        return self

    def __exit__(self, *_) -> None:
        self.release()


def dense(spark: SparkSession, tables: Mapping[str, Sequence[Part]]) -> set[str]:
    """Tables whose keys are proven to be 1, 2, … n, each once: as many rows as the largest key, and the fingerprint of those
    numbers (a 64-bit hash, order-free). One job without input for all tables."""
    spans, prints = {}, {}
    for name, parts in tables.items():
        rows, lows, highs = sum(p.rows for p in parts), [p.low for p in parts if p.rows], [p.high for p in parts if p.rows]
        if None in lows or rows and (min(lows) != 1 or max(highs) != rows):
            continue
        spans[name], prints[name] = rows, 0
        for p in parts:
            prints[name] ^= p.print or 0
    if not spans:
        return set()
    wanted = [spark.range(1, n + 1).agg(F.coalesce(F.bit_xor(F.xxhash64("id")), F.lit(0).cast("long")).alias("print")).select(
        F.lit(name).alias("tbl"), "print") for name, n in spans.items()]
    expected = wanted[0]
    for more in wanted[1:]:
        expected = expected.unionByName(more)
    return {r["tbl"] for r in expected.collect() if r["print"] == prints[r["tbl"]]}
