"""Operators 11 to 13 against plain versions, with the edge cases their docstrings define."""

import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm import filter_audit, oracles, queries, simhash, spelling
from tests.llm import brute
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")
#: Extra columns carry names that the operators use themselves.
EXTRA = "id string, hash int, n long, word string, print string, part int, bits int"


def frame(spark, rows, columns="doc_id long, text string, source string"):
    return spark.createDataFrame([(*r, "x", 1, 2, "w", "p", 3, 4) for r in rows], f"{columns}, {EXTRA}").repartition(3)


def prose(rng, n, size=300):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


# filter interaction audit


@pytest.fixture(scope="module")
def audited():
    rng = random.Random(5)
    texts = [None, "", " \n ", "A|B", prose(rng, 80, 20), prose(rng, 90, 5000), prose(rng, 90, 5000).upper(), "# " + prose(rng, 70, 3000),
             prose(rng, 49, 9000), prose(rng, 50, 9000), prose(rng, 20_000, 400), "É" * 30 + " ABC"]
    return [(i, rng.choice(texts), rng.choice(["web", "", None, "forum"])) for i in range(120)] + [
        (None, texts[5], "web"), (None, texts[5], "web"), (None, None, None), (7, texts[4], "web"), (7, texts[4], "web"), (7, texts[9], "web"),
        (-3, texts[10], "forum")]


def test_filter_audit(spark, audited):
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 120, 3)] + [(7, 0, 0), (7, 1, None), (None, 1, 1), (8, None, 3), (999, 1, 1)]
    table = spark.createDataFrame([(*x, 0) for x in labels], "doc_id long, quality int, toxic int, bits int")
    ours = filter_audit.audit(frame(spark, audited), table)
    assert ours.columns == ["part", "filter_order", "step", *filter_audit.MEASURES]
    found = {(r["part"], r["filter_order"], r["step"]): list(r[3:]) for r in ours.collect()}
    theirs = brute.audit(audited, labels)
    assert len(found) == 3 * 600 and found == theirs
    assert all(any(m[k] for m in found.values()) for k in range(7))


def test_filter_audit_of_no_labels_and_of_nothing(spark, audited):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(frame(spark, audited), none).collect()
    assert len(rows) == 1800 and not any(r["good_lost"] or r["toxic_lost"] for r in rows)
    assert filter_audit.audit(frame(spark, []), none).collect() == []


def test_filter_audit_reads_hot_copies_once_on_the_right(spark):
    """The side that is searched holds one row per text, however many documents share it."""
    rows = spark.range(3000).select("id", F.lit("").alias("part"), F.lit(1).cast("long").alias("hash"), F.lit("same").alias("text"))
    copies = filter_audit.later_copies(rows, rows)
    assert copies.count() == 2999
    assert "LeftSemi" in copies._jdf.queryExecution().optimizedPlan().toString()


# spelling variants


def misspelt(rng, word):
    i, letter = rng.randrange(len(word)), rng.choice("aeéÿÀxz")
    return rng.choice([word[:i] + word[i + 1:], word[:i] + letter + word[i:], word[:i] + letter + word[i + 1:]])


@pytest.fixture(scope="module")
def lexicon():
    """Counts of invented words and of chains of their misspellings."""
    rng = random.Random(11)
    counts = {}
    for _ in range(60):
        word, n = "".join(rng.choice("aabcdeéÀst") for _ in range(rng.randrange(6, 12))), rng.choice([5, 30, 700])
        for _ in range(rng.randrange(1, 9)):
            counts.setdefault(word, n)
            word, n = misspelt(rng, rng.choice(list(counts))), max(5, n // rng.choice([1, 5, 6]))
    counts |= {"aaaaaa": 50, "aaaaaaa": 10, "aaaaaaaa": 10, "ababab": 7, "bababa": 9, "abababa": 8, "x" * 400: 5, "x" * 401: 25}
    return {w: n for w, n in counts.items() if len(w) >= 4}


def test_spelling_variants(spark, lexicon):
    words = spark.createDataFrame(list(lexicon.items()), "word string, n long")
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(words).collect()}
    theirs = brute.variants(lexicon)
    assert found == theirs
    assert any(v[0] and v[0] != v[1] for v in theirs.values())  # a form that has a form


def test_pivots_share_no_letter_and_cost_least(lexicon):
    rng = random.Random(2)
    for word in lexicon:
        order = {word[i:i + 2]: (rng.randrange(10_000), rng.randrange(1, 50)) for i in range(len(word) - 1)}
        grams = spelling.prefix(word, order)
        chosen = spelling.pivots(grams)
        pairs = [a[2] + b[2] for a in grams for b in grams if b[1] - a[1] >= 2]
        assert len(grams) >= 3 and len(chosen) == 2 and chosen[1][1] - chosen[0][1] >= 2
        assert sum(g[2] for g in chosen) == min(pairs)


def test_spelling_of_texts(spark):
    rng = random.Random(4)
    stems = ["Gröning", "wonder", "Wonderful", "ÀÉÎõüÿ", "short", "straße×", "letters", "harbour"]
    docs = [(i, " ".join(rng.choice(stems) if rng.random() < 0.9 else misspelt(rng, rng.choice(stems)) for _ in range(300)) + "…日本 it's", "s")
            for i in range(40)]
    docs += [(None, "harbour " * 40, "s"), (5, "harbour letters", "s"), (5, "harbour letters", "s"), (6, None, "s"), (7, "", "s"), (8, "12 34", "s")]
    found = {r["word"]: tuple(r)[1:] for r in spelling.group(frame(spark, docs)).collect()}
    theirs = {w: (form, root, n, near, form_n) for w, (form, root, n, near, form_n) in brute.variants(brute.spelling_words([d[:2] for d in docs])).items()}
    assert found == theirs and sum(v[0] is not None for v in found.values()) > 5
    assert spelling.group(frame(spark, [])).collect() == []


# simhash


def test_fingerprints_equal_plain_ones():
    rng = random.Random(9)
    texts = [None, "", " \t\n", "One", "one TWO", "one\x0btwo  three", "Ünï É " * 5, prose(rng, 70_000), "", "a b c d a b c d", "x\x1fy z", None]
    assert simhash.text_fingerprints(pa.array(texts, pa.string()), 3).tolist() == [brute.simhash(t) for t in texts]
    assert simhash.text_fingerprints(pa.array(texts, pa.string())[2:9], 3).tolist() == [brute.simhash(t) for t in texts[2:9]]
    assert simhash.text_fingerprints(pa.array([], pa.string()), 3).tolist() == []


@pytest.mark.parametrize("max_bits", [0, 1, 2])
@pytest.mark.parametrize("longest", [0, 3, 64])
def test_simhash_links_connect_all_near_fingerprints(spark, max_bits, longest):
    rng = random.Random(max_bits)
    prints = {0, (1 << 64) - 1, 1 << 63, 3 << 62}
    for _ in range(6):  # groups of fingerprints that stray step by step
        at = rng.getrandbits(64)
        for _ in range(30):
            prints.add(at)
            for _ in range(rng.randrange(4)):
                at ^= 1 << rng.choice([rng.randrange(64), rng.randrange(8)])
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "print long")
    found = [(r["a"], r["b"]) for r in simhash.links(table, max_bits, longest).collect()]

    def near(i, j):
        return ((i ^ j) & ((1 << 64) - 1)).bit_count() <= max_bits

    pairs = set(found) | {(b, a) for a, b in found}
    assert brute.closed(signed, near) == brute.closed(signed, lambda i, j: (i, j) in pairs)


@pytest.mark.parametrize("longest", [2, 64])
def test_simhash_near_duplicates(spark, longest):
    rng = random.Random(3)
    base = [f"v{i}" for i in range(1500)]
    docs = [(1000, None), (1001, ""), (1002, " \n"), (1003, "One two"), (1004, "one TWO"), (1005, "É")]
    docs += [(i, prose(rng, rng.randrange(1, 60))) for i in range(40)]
    for i in range(50):  # near copies
        copy = list(base)
        copy[rng.randrange(1500)] = f"new{i}"
        docs.append((100 + i, " ".join(copy)))
    docs += [(200 + i, docs[12][1]) for i in range(12)]
    ours = simhash.near_duplicates(frame(spark, [(*d, "s") for d in docs]), longest=longest)
    prints = {i: brute.simhash(t) for i, t in docs}
    least = brute.closed(prints, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    assert ours.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, ours.collect())) == sorted((i, f"{prints[i]:016x}", least[i]) for i in prints)
    assert len(set(least.values())) < len(docs) - 25


def test_simhash_rows_of_one_id_and_without_id(spark):
    rng = random.Random(6)
    a, b, c = (prose(rng, 40) for _ in range(3))
    docs = [(5, a), (9, a), (9, b), (7, b), (9, b), (None, a), (None, c), (3, None), (None, " ")]
    rows = simhash.near_duplicates(frame(spark, [(*d, "s") for d in docs])).collect()
    assert sorted((r[0] or -1, r[2] or -1) for r in rows) == [(-1, -1), (-1, 3), (-1, 5), (3, 3), (5, 5), (7, 5), (9, 5), (9, 5), (9, 5)]
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


# queries


@needs_data
@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_spelling"])
def test_queries_equal_their_sql(spark, name):
    assert compare(queries.registered()[name](spark, FOLDER), connect(FOLDER), oracles.ORACLES[name]) is None


@needs_data
def test_simhash_query_equals_plain_version(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    prints = {i: brute.simhash(t) for i, t in docs}
    least = brute.closed(prints, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    rows = queries.op13_simhash(spark, FOLDER).collect()
    assert sorted(map(tuple, rows)) == sorted((i, f"{prints[i]:016x}", least[i]) for i in prints)
