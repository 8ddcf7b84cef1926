"""The sketch join against all pairs."""

import random
import re
from collections import defaultdict

import duckdb
import numpy as np
from pyspark.sql import functions as F

from conftest import DATA
from roadstream.llm import jaccard as j
from roadstream.llm import words
from roadstream.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string"


def shingles(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))) if own else frozenset()


def expected(rows, percent=75):
    """Component of each id, from all pairs."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def check(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    found = j.near_duplicates(docs).collect()
    want = expected(rows)
    assert len(found) == len(rows)
    for row in found:
        assert row.component_id == (None if row.doc_id is None else want[row.doc_id])
    sizes = {i: len(shingles(t)) for i, t in rows}
    assert all(r.n_shingles == sizes[r.doc_id] for r in found)


def changed(rng, own, n):
    own = list(own)
    for _ in range(n):
        own[rng.randrange(len(own))] = f"w{rng.random()}"
    return own


def test_groups_of_copies(spark):
    """Chains of near copies, exact copies and passages that unlike texts share."""
    rng = random.Random(5)
    passage = [f"p{k}" for k in range(60)]
    rows, words_of = [], []
    for size in (1, 3, 5, 6, 7, 8, 9, 12, 16, 17, 20, 40, 64, 70, 150, 260, 400):
        own = [f"t{size}_{k}" for k in range(size)]
        for step in range(6):
            words_of.append(list(own))
            own = changed(rng, own, 1 + size // 40 * (step % 3))
    base = [f"b{k}" for k in range(120)]
    words_of += [changed(rng, base, rng.randrange(3)) for _ in range(60)]
    for _ in range(40):  # the larger part in common, but not enough for a link
        words_of.append([f"u{rng.random()}" for _ in range(rng.randrange(20, 60))] + passage)
    words_of += [words_of[3]] * 30
    for i, own in enumerate(words_of):
        rows.append((i * 3, (" " if i % 2 else "\n").join(own).title()))
    rng.shuffle(rows)
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One"), (6, "one two"), (7, "a b c d e"),
            (8, "A  b\nc d\te"), (9, "word " * 5000), (10, "word " * 900), (11, "x" * 100_000),
            (None, "a b c d e"), (12, "café É"), (13, "café é")]
    check(spark, rows)
    check(spark, [])
    again = spark.createDataFrame([(7, "a b c d e", 1), (7, "a b c d e", 2)], SCHEMA + ", node int")
    assert {r.component_id for r in j.near_duplicates(again).collect()} == {7}


def test_registered_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    theirs = con.sql(ORACLES["op5_jaccard"])
    ours = QUERIES["op5_jaccard"](spark, DATA).select(theirs.columns).collect()
    assert sorted(map(tuple, ours)) == sorted(theirs.fetchall())


def test_large_group(spark, monkeypatch):
    """One key held by many nodes: ranks cell by cell, pivots a block at a time."""
    monkeypatch.setattr(j, "BLOCK", 16)
    monkeypatch.setattr(j, "CELL", 50)
    rng = np.random.default_rng(8)
    sets, label = {}, {}
    for i in range(300):
        base = rng.integers(0, 2**63, 40).astype(np.uint64) if i % 4 == 0 else base
        fresh = rng.integers(0, 2**63, int(rng.integers(0, 14))).astype(np.uint64)
        sets[i] = np.unique(np.concatenate([base, fresh]))
        label[i] = i // 10 * 10 if i < 100 else i
    rows = [(i, len(s), j.parity_bits(s).tobytes()) for i, s in sets.items()]
    nodes = spark.createDataFrame(rows, "node long, size long, sketch binary")
    labels = spark.createDataFrame(list(label.items()), "node long, label long").filter("node < 100")
    left = nodes.select(F.lit(7).cast("long").alias("key"), "node")
    settled = spark.createDataFrame([(8, 1), (8, 2), (8, 3)], "key long, node long")
    found = j._unsettled(left.union(settled), labels)
    ranked = sorted((r["rank"], r.key, r.n, label[r.node]) for r in found.collect())
    assert [r[:3] for r in ranked] == [(k + 1, 7, 300) for k in range(300)]
    assert [r[3] >= 100 for r in ranked] == [True] * 200 + [False] * 100
    met = {(r.a, r.b) for r in j._group_pairs(found, nodes, 75, 300).collect()}
    want = set()
    for a in sets:
        for b in range(a + 1, 300):
            short, long = sorted((len(sets[a]), len(sets[b])))
            differ = j.least_difference(j.parity_bits(sets[a]), j.parity_bits(sets[b]))
            may = 100 * short >= 75 * long and j._similar(75, short, long, differ)
            if may and label[a] != label[b]:
                want.add((a, b))
    assert met == want and len(want) > 100


def test_similar_sets_share_a_key():
    """Any two sets at the limit meet, whatever the order makes of common shingles."""
    rng = np.random.default_rng(3)
    for size in [*range(3, 80), 100, 170, 255, 256, 257, 300, 700, 1024, 1500]:
        for extra in {0, 1, size // 8, size // 4, size // 3}:
            both = int(rng.integers(max(1, size * 3 // 4), size + 1))
            pool = rng.integers(0, 2**63, 4 * size).astype(np.uint64)
            a = np.unique(pool[:size])
            b = np.unique(np.concatenate([pool[:both], pool[size : size + extra]]))
            common = np.sort(pool[rng.random(len(pool)) < rng.random()])
            inter = len(np.intersect1d(a, b))
            if 100 * inter >= 75 * (len(a) + len(b) - inter) and min(len(a), len(b)) >= 3:
                keys = np.intersect1d(j.block_keys(a, common), j.block_keys(b, common))
                assert len(keys), (size, extra)
            difference = len(a) + len(b) - 2 * inter
            assert j.least_difference(j.parity_bits(a), j.parity_bits(b)) <= difference


def test_similar_small_sets_of_common_shingles_share_a_key():
    """Empty blocks stand last in the order, also for a set that needs none of them."""
    rng = np.random.default_rng(4)
    for _ in range(30_000):
        size = int(rng.integers(3, 17))
        pool = np.sort(rng.integers(0, 2**63, size + size // 3).astype(np.uint64))
        a, b = np.sort(rng.permutation(pool)[:size]), pool
        assert len(np.intersect1d(j.block_keys(a, pool), j.block_keys(b, pool))), size


def test_word_hashes_are_those_of_words():
    texts = ["One two", "", None, "two  ONE\n", "É one"]
    hashes, counts = words.word_hashes(texts)
    assert counts.tolist() == [2, 0, 0, 2, 2]
    seen = defaultdict(set)
    for word, h in zip(["one", "two", "two", "one", "É", "one"], hashes.tolist(), strict=True):
        seen[word].add(h)
    assert all(len(x) == 1 for x in seen.values()) and len({min(x) for x in seen.values()}) == 3
    assert [len(s) for s in words.shingle_sets(["a b c d e f", "a", "", "a a a a a a a"], 5)] == [2, 1, 0, 1]


def test_one_of_each(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, "q"), (None, "z"), (4, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = sorted((r.doc_id or 0, r.text) for r in j.one_of_each(docs).collect())
    assert [i for i, _ in kept] == [0, 1, 3, 4]
