"""Near-duplicate components by an n-gram Jaccard join with adaptive multi-match prefixes (operator 8).

A document's set is its distinct ``size``-word shingles as 64-bit hashes; a document of fewer words, but
not none, has its whole word sequence as one shingle. Two documents link when ``100 * intersection >=
percent * union``. Documents without words link with nothing.

1. Documents with equal sets are one class, represented by its smallest doc_id; a class with a third of
   all rows is merged before the shuffle. Only classes go on.
2. Shingles are ordered by hash. With n shingles, any link shares at least l shingles within the first
   ``base + l - 1`` of both, where base = n - ceil(n * percent / 100) + 1, for every l. The shingles of a
   prefix with room for several l are counted over all classes; those in one class only link nothing.
3. Each class picks its own l by estimated cost: the pairs its prefix brings up, and how many of them
   would be verified if so many shared shingles are asked for. Shingles in more than ``hot`` classes
   (a passage that many documents share) bring up no pairs: they only lengthen the prefix, and with it
   the number of shared shingles needed, until more are needed than hot ones can supply. A pair is
   verified if it shares as many other shingles as the one with the smaller l needs.
4. Classes of which nearly all shingles are hot, as in large groups of near copies, cannot reach that.
   Their whole sets are compared with the prefixes of the others. Among themselves they are linked to a
   central class of equal min-hash first; shingles are then counted by the groups so found, and only
   pairs of different groups that share one of their rarest shingles are compared. The join holds a
   signature of each set against the other's and gives out only pairs whose sets may differ in few
   enough shingles, so copies that each changed elsewhere, too much for a link, are not paired.
5. All remaining pairs are verified on whole sets, and links joined to components.

No step limits the number of candidates of a class, and no order, count or l can lose a link.

Edge cases: NULL text reads as the empty text. Rows of one doc_id are one document: it links wherever
one of its texts does; each row reports the size of its own set. Rows without doc_id are in no
component (NULL) and link nothing. Empty tables give empty results. Columns other than id and text are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stratalake.llm import batches
from stratalake.llm.components import components
from stratalake.llm.frames import Table
from stratalake.session import stage

_SEEDS = 4  # min-hashes that look for a central class
_SIGNATURE = [f"s{i}" for i in range(16)]  # 64 bits each
_PREFIXES = "doc long, n long, low long, high long, region array<long>"
_SETS = "doc long, n long, tokens array<long>"
_CHOSEN = "doc long, n long, l int, need int, t long"

#: Spark's own filter of join keys, also for tables below its default size: most rows have no partner.
_FILTER_KEYS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64MB",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def base_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles of a prefix in which any link shares at least one."""
    return n + (-percent * n) // 100 + 1


def region_length(n: np.ndarray, percent: int) -> np.ndarray:
    """The longest prefix that is counted: the base and room for some more matches."""
    base = base_length(n, percent)
    return np.minimum(n, base + 3 + base // 4)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of each text, and where each text's start, with a closing entry."""
    words = batches.words(*batches.buffers(texts))
    doc = np.repeat(np.arange(len(texts)), words.counts)
    at = np.flatnonzero(words.inside(size))
    hashes, docs = [words.grams(size)[at]], [doc[at]]
    for few in range(1, size):
        rows = np.flatnonzero(words.counts == few)
        hashes.append(words.grams(few, seed=97)[words.first[:-1][rows]])
        docs.append(rows)
    hashes, docs = np.concatenate(hashes), np.concatenate(docs)
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    return hashes[new], np.searchsorted(docs[new], np.arange(len(texts) + 1))


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(values.view(np.int64)))


def _prefixes(parts: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        for part in batches.slices(batch, "_text"):
            tokens, ends = shingle_sets(part.column("_text"), size)
            n = np.diff(ends)
            digests = []
            for seed in (21, 22):
                sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(batches.mix(tokens, seed))))
                digests.append((sums[ends[1:]] - sums[ends[:-1]]).view(np.int64))
            length = np.where(n > 0, region_length(n, percent), 0)
            region = tokens[batches.ranges(ends[:-1], length)]
            yield pa.record_batch([part.column("_id"), pa.array(n.astype(np.int64)), pa.array(digests[0]), pa.array(digests[1]),
                                   _lists(region, np.concatenate(([0], np.cumsum(length))))],
                                  names=["doc", "n", "low", "high", "region"])


def _whole_sets(parts: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        for part in batches.slices(batch, "_text"):
            tokens, ends = shingle_sets(part.column("_text"), size)
            yield pa.record_batch([part.column("_id"), pa.array(np.diff(ends).astype(np.int64)), _lists(tokens, ends)],
                                  names=["doc", "n", "tokens"])


def choose(n: int, places: np.ndarray, counts: np.ndarray, percent: int, hot: int, verify_cost: int) -> tuple[int, int]:
    """(l, need) of a class with the least estimated cost; need 0 if hot shingles alone could supply l.

    ``places`` and ``counts`` are its shared shingles in the region. A prefix that brings up P pairs can
    hold at most P / need pairs with that many matches.
    """
    base, region = (int(f(np.int64(n), percent)) for f in (base_length, region_length))
    best, chosen = None, (region - base + 1, 0)
    for l in range(1, region - base + 2):
        inside = places < base + l - 1
        need = l - int((inside & (counts > hot)).sum())
        if need > 0:
            pairs = int((counts[inside & (counts <= hot)] - 1).sum())
            cost = pairs + verify_cost * pairs / need
            if best is None or cost < best:
                best, chosen = cost, (l, need)
    return chosen


def _choose_all(parts: Iterator[pa.RecordBatch], percent: int, hot: int, verify_cost: int) -> Iterator[pa.RecordBatch]:
    """A row per shingle that may bring up pairs; one row without a shingle for a class with need 0."""
    for batch in parts:
        rows = []
        for doc, n, shared in zip(*(batch.column(c).to_pylist() for c in ("doc", "n", "shared"))):
            places = np.array([s["place"] for s in shared])
            counts = np.array([s["c"] for s in shared])
            l, need = choose(n, places, counts, percent, hot, verify_cost)
            if not need:
                rows.append((doc, n, l, 0, None))
                continue
            prefix = int(base_length(np.int64(n), percent)) + l - 1
            rows += [(doc, n, l, need, s["t"]) for s in shared if s["place"] < prefix and s["c"] <= hot]
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        columns = zip(*rows) if rows else ((),) * 5
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["doc", "n", "l", "need", "t"])


def _min_hashes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        lists, docs = batch.column("tokens"), np.arange(batch.num_rows)
        tokens = lists.flatten().to_numpy().astype(np.int64).view(np.uint64)
        first = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))[:-1].astype(np.int64)
        for seed in range(_SEEDS):
            keys = np.minimum.reduceat(batches.mix(tokens, 50 + seed), first) if len(docs) else tokens
            yield pa.record_batch([batch.column("doc"), pa.array(np.full(len(docs), seed, dtype=np.int32)), pa.array(keys.view(np.int64))],
                                  names=["doc", "seed", "key"])


def signatures(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of 1,024 bits per set, as longs: each bit is the parity of the shingles that fall on it.

    Two signatures differ in no more bits than their sets differ in shingles: a shingle of both changes
    neither or both, one of a single set changes one bit.
    """
    bits = 64 * len(_SIGNATURE)
    rows = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    places = (batches.mix(tokens, 80) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(rows * bits + places, minlength=(len(ends) - 1) * bits) % 2
    return np.packbits(odd.astype(bool).reshape(-1, bits), axis=1).view(np.int64)


def _signatures(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            lists = part.column("tokens")
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy()))).astype(np.int64)
            found = signatures(lists.flatten().to_numpy().astype(np.int64).view(np.uint64), ends)
            yield pa.record_batch([part.column("doc"), *map(pa.array, found.T)], names=["doc", *_SIGNATURE])


def _verify(parts: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        a, b = [], []
        left, right = batch.column("x"), batch.column("y")
        ids = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())
        for i, (doc, other) in enumerate(ids):
            x, y = left[i].values.to_numpy(), right[i].values.to_numpy()
            both = np.sort(np.concatenate((x, y)))
            common = int((both[1:] == both[:-1]).sum())
            if 100 * common >= percent * (len(both) - common):
                a.append(doc)
                b.append(other)
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


class _Join:
    """The steps on one table of texts."""

    def __init__(self, texts: DataFrame, size: int, percent: int, hot: int, verify_cost: int):
        self.texts, self.spark = texts, texts.sparkSession
        self.size, self.percent, self.hot, self.verify_cost = size, percent, hot, verify_cost

    def rows(self) -> DataFrame:
        size, percent = self.size, self.percent
        return stage(self.texts.mapInArrow(lambda parts: _prefixes(parts, size, percent), _PREFIXES))

    def sets_of(self, docs: DataFrame) -> DataFrame:
        """Whole sets of the documents ``docs`` (doc), read from their texts again."""
        size = self.size
        wanted = stage(docs.distinct()).filter("doc >= -9223372036854775808")
        with _settings(self.spark, _FILTER_KEYS):
            chosen = self.texts.join(wanted, F.col("_id") == F.col("doc"), "left_semi")
            return stage(chosen.mapInArrow(lambda parts: _whole_sets(parts, size), _SETS).distinct())

    def alike(self, a: str, b: str):
        """Whether two set sizes allow a link."""
        return 100 * F.least(a, b) >= self.percent * F.greatest(a, b)

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        percent = self.percent
        x = sets.select(F.col("doc").alias("a"), F.col("tokens").alias("x"))
        y = sets.select(F.col("doc").alias("b"), F.col("tokens").alias("y"))
        return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(
            lambda parts: _verify(parts, percent), "a long, b long").distinct()

    def chosen(self, classes: DataFrame) -> DataFrame:
        """What each class chose of its shingles that other classes hold too."""
        percent, hot, verify_cost = self.percent, self.hot, self.verify_cost
        tokens = classes.select("doc", "n", F.posexplode("region").alias("place", "t"))
        shared = stage(tokens.groupBy("t").agg(F.count(F.lit(1)).alias("c")).filter("c >= 2"))
        with _settings(self.spark, _FILTER_KEYS):
            by_class = tokens.join(shared.filter("c >= 2"), "t").groupBy("doc", "n").agg(
                F.collect_list(F.struct("place", "t", "c")).alias("shared"))  # at most one class's region
            return stage(by_class.mapInArrow(lambda parts: _choose_all(parts, percent, hot, verify_cost), _CHOSEN))

    def matched(self, certain: DataFrame) -> DataFrame:
        """Pairs (a, b) of classes that share as many shingles as needed."""
        x = certain.select("t", *(F.col(c).alias(f"{c}_x") for c in ("doc", "n", "l", "need")))
        y = certain.select("t", *(F.col(c).alias(f"{c}_y") for c in ("doc", "n", "l", "need")))
        need = F.when(F.col("l_x") < F.col("l_y"), F.col("need_x")).when(F.col("l_x") > F.col("l_y"), F.col("need_y")) \
            .otherwise(F.greatest("need_x", "need_y"))
        return x.join(y, (x["t"] == y["t"]) & (F.col("doc_x") < F.col("doc_y")) & self.alike("n_x", "n_y")) \
            .groupBy(F.col("doc_x").alias("a"), F.col("doc_y").alias("b")) \
            .agg(F.count(F.lit(1)).alias("common"), F.min(need).alias("need")).filter("common >= need").select("a", "b")

    def matched_whole(self, sets: DataFrame, certain: DataFrame) -> DataFrame:
        """Pairs of a class whose whole set is looked up, and another class's prefix."""
        x = sets.select(F.col("doc").alias("a"), F.col("n").alias("n_x"), F.explode("tokens").alias("t"))
        y = certain.select("t", F.col("doc").alias("b"), F.col("n").alias("n_y"), "need")
        return x.join(y, (x["t"] == y["t"]) & (F.col("a") != F.col("b")) & self.alike("n_x", "n_y")) \
            .groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"), F.min("need").alias("need")) \
            .filter("common >= need").select("a", "b")

    def central_links(self, sets: DataFrame, tokens: DataFrame) -> DataFrame:
        """Verified links of each class to the class with the fewest shingles of its own among those
        of an equal min-hash."""
        rare = tokens.groupBy("doc").agg(F.count(F.when(F.col("c") == 1, 1)).alias("rare"))
        keys = sets.mapInArrow(_min_hashes, "doc long, seed int, key long").join(rare, "doc")
        center = keys.groupBy("seed", "key").agg(F.min(F.struct("rare", "doc"))["doc"].alias("center"))
        pairs = keys.join(center, ["seed", "key"]).select(F.col("doc").alias("a"), F.col("center").alias("b"))
        return stage(self.verified(stage(pairs.filter("a <> b").distinct()), sets))

    def matched_groups(self, sets: DataFrame, links: DataFrame) -> DataFrame:
        """Pairs of classes in different groups that share one of their rarest shingles by groups, near
        enough to the front of both for the rest to make up a link, and whose signatures allow one."""
        groups = components(links)
        named = sets.join(groups, sets["doc"] == groups["node"], "left").select(
            "doc", "n", F.coalesce("component", "doc").alias("g"), "tokens")
        grouped = stage(named.select("doc", "n", "g", F.explode("tokens").alias("t")))
        spread = grouped.select("t", "g").distinct().groupBy("t").agg(F.count(F.lit(1)).alias("groups"))
        order = F.row_number().over(Window.partitionBy("doc", "n").orderBy("groups", "t"))
        prefix = F.col("n") - F.ceil(F.col("n") * self.percent / 100) + 1
        rare = stage(grouped.join(spread, "t").withColumn("place", order).filter(
            (F.col("place") <= prefix) & (F.col("groups") > 1)).select("t", "doc", "n", "g", "place"))
        signed = sets.mapInArrow(_signatures, "doc long, " + ", ".join(f"{c} long" for c in _SIGNATURE))
        rare = stage(rare.join(signed, "doc"))
        x, y = (rare.select("t", *(F.col(c).alias(f"{c}_{s}") for c in ("doc", "n", "g", "place", *_SIGNATURE))) for s in "xy")
        # the first shared shingle of a link leaves enough of both sets behind it
        most = 1 + F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y"))
        both = F.col("n_x") + F.col("n_y")
        enough = 100 * most >= self.percent * (both - most)
        apart = reduce(add, (F.bit_count(F.col(f"{c}_x").bitwiseXOR(F.col(f"{c}_y"))) for c in _SIGNATURE))
        near = (100 + self.percent) * apart <= (100 - self.percent) * both
        return x.join(y, (x["t"] == y["t"]) & (F.col("doc_x") < F.col("doc_y")) & (F.col("g_x") != F.col("g_y")) & enough
                      & self.alike("n_x", "n_y") & near).select(F.col("doc_x").alias("a"), F.col("doc_y").alias("b"))


def join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 4, percent: int = 85,
         hot: int = 64, verify_cost: int = 20) -> tuple[DataFrame, DataFrame]:
    """(rows, links). rows: one per row of ``docs`` with doc (its id), n and its class; links: verified
    pairs (a, b) of classes, enough of them to connect all that link."""
    table = Table(docs)
    steps = _Join(table.df.select(table.col(id_column).cast("long").alias("_id"), table.col(text_column).cast("string").alias("_text")),
                  size, percent, hot, verify_cost)
    rows = steps.rows()
    named = rows.filter("n > 0 and doc is not null")
    classes = stage(named.groupBy("n", "low", "high").agg(F.min("doc").alias("doc"), F.first("region").alias("region")))
    chosen = steps.chosen(classes)

    certain = chosen.filter("need > 0")
    pairs = steps.matched(certain)
    dense = steps.sets_of(chosen.filter("need = 0").select("doc"))
    tokens = dense.select("doc", "n", F.explode("tokens").alias("t"))
    tokens = stage(tokens.join(tokens.groupBy("t").agg(F.count(F.lit(1)).alias("c")), "t"))
    central = steps.central_links(dense, tokens)
    pairs = pairs.unionByName(steps.matched_whole(dense, certain)).unionByName(
        steps.matched_groups(dense, central))
    pairs = stage(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    sets = steps.sets_of(pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))))
    links = central.unionByName(steps.verified(pairs, sets))

    owners = classes.select("n", "low", "high", F.col("doc").alias("class"))
    rows = rows.select("doc", "n", "low", "high").join(owners, ["n", "low", "high"], "left").select(
        "doc", "n", F.when(F.col("doc").isNotNull(), F.col("class")).alias("class"))
    several = rows.filter("class is not null").groupBy("doc").agg(F.min("class").alias("a"), F.max("class").alias("b")).filter("a < b")
    same = rows.join(several.select("doc", "a"), "doc").select("a", F.col("class").alias("b")).filter("a <> b")
    return rows, stage(links.unionByName(same).distinct())


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, the smallest doc_id reachable by links."""
    rows, links = join(docs, **settings)
    groups = stage(components(links))
    return rows.join(groups, rows["class"] == groups["node"], "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "class", "doc").alias("component_id"))
