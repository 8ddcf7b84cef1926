"""Runs, line dedup and hard negatives against brute force and their SQL."""

import os
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from roadstream.llm import lines, negatives, periodic, queries

DATA = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, runs int, kept string, id int, line string, c0 string"


@pytest.mark.parametrize("name", ["op11_runs", "op12_negatives", "op13_lines"])
def test_registered_queries_match_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
    theirs = con.execute(queries.ORACLES[name]).fetchall()
    names = [c[0] for c in con.description]
    ours = [tuple(r[c] for c in names) for r in queries.QUERIES[name](spark, DATA).collect()]
    assert ours and sorted(map(str, ours)) == sorted(map(str, theirs))


# Runs


def brute_runs(words, least_length, least_exponent):
    n, out = len(words), {}
    for q in range(n // 2, 0, -1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least_length, least_exponent * q):
                out[i, j + q] = q
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def by_start_and_period(runs):
    return sorted(runs, key=lambda r: (r[0], r[2]))


def test_runs_of_random_texts():
    rng = random.Random(3)
    for _ in range(600):
        texts = []
        for _ in range(rng.randint(1, 4)):
            words = rng.choices("abcd"[: rng.randint(1, 4)], k=rng.randint(0, 40))
            if len(words) > 4 and rng.random() < 0.5:
                a, p = rng.randrange(len(words)), rng.randint(1, 5)
                words = words[:a] + (words[a : a + p] * 40)[: len(words) - a]
            texts.append(" ".join(words))
        least, exponent = rng.choice([(2, 2), (6, 3), (6, 4)])
        for text, (n, runs, kept) in zip(
            texts, periodic.analyse(texts, least, exponent), strict=True
        ):
            words = text.split()
            assert n == len(words)
            assert runs == by_start_and_period(brute_runs(words, least, exponent))
            gone = {i for s, length, q in runs for i in range(s + q, s + length)}
            assert kept == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_long_and_odd_texts():
    long = "a b c d e " * 60_000
    texts = [long, None, "", " \n\t", "x x x x", "y " * 6, "z " * 5, "A a " * 3]
    found = periodic.analyse(texts, 6, 4)
    assert [runs for _, runs, _ in found] == [
        [(0, 300_000, 5)], [], [], [], [], [(0, 6, 1)], [], []
    ]
    assert found[0][2] == "a b c d e" and found[5][2] == "y" and found[7][2] == "A a A a A a"


def test_one_slice_or_many_give_the_same(monkeypatch):
    texts = ["u v " * k + "w " * k for k in range(40)]
    whole = periodic.analyse(texts, 6, 4)
    monkeypatch.setattr(periodic, "SLICE_WORDS", 7)
    assert periodic.analyse(texts, 6, 4) == whole


def test_runs_as_columns(spark):
    rows = [(1, "p q " * 4, 7, "k"), (1, "p q " * 4, 7, "k"), (None, None, None, None), (2, "", 0, "")]
    rows += [(3, "b b b b b b a " + "c " * 6, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, periodic int, best string")
    done = periodic.with_runs(docs)
    assert done.columns == docs.columns
    found = done.select(
        "doc_id", periodic.greatest("periodic.runs"), periodic.as_lines("periodic.runs")
    ).collect()
    by_id = defaultdict(list)
    for doc_id, best, text in found:
        by_id[doc_id].append((best and tuple(best), text))
    assert by_id[1] == [((0, 8, 2), "0,8,2\n")] * 2
    assert by_id[3] == [((0, 6, 1), "0,6,1\n7,6,1\n")]  # ties go to the first
    assert by_id[None] == by_id[2] == [(None, "")]
    assert periodic.with_runs(docs.limit(0)).count() == 0


def test_repeated_tail():
    words = [str(i) for i in range(20)]
    got = periodic.repeated_tail(" ".join(words), 43).split()
    a, p = 43 % 20, 1 + (20 - 43 % 20) // (3 + 43 % 8)
    assert got == [words[i if i < a else a + (i - a) % p] for i in range(20)]
    assert periodic.repeated_tail(None, 3) is None and periodic.repeated_tail(" ", 3) == " "


# Lines


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()


def brute_lines(rows, least_chars=40, least_docs=5):
    held = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            held[key_of(line)].add(doc_id)
    holder = {
        k: max(ids, key=lambda i: (i is not None, i or 0))
        for k, ids in held.items()
        if len(k) >= least_chars and len(ids) >= least_docs
    }
    out = []
    for doc_id, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if holder.get(key_of(x), doc_id) == doc_id]
        out.append((doc_id, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def made_up_lines():
    rng = random.Random(5)
    pool = [f"{'é' if k % 3 else 'E'}line {k} of a passage " + "abcde " * (k % 6) for k in range(30)]
    rows = []
    for doc_id in range(60):
        own = rng.choices(pool, weights=range(1, 31), k=rng.randint(0, 8))
        own = [rng.choice([x, x.upper(), f" \t{x}\x0b\r", f" {x}"]) for x in own]
        rows.append((doc_id, "\n".join(own)))
    hot = "the very same line in a third of all of the documents"
    rows += [(i, f"{hot}\n\n{hot}") for i in range(60, 90)]
    rows += rows[:5] + [(7, "another text " + hot), (None, hot), (None, f"x\n{hot}"), (3, None)]
    rows += [(200, "\n" * 30_000 + hot), (201, ""), (202, hot[:39]), (203, "é" * 40 + "\n" + "é" * 39)]
    return rows


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_lines_against_brute_force(spark, batches):
    rows = made_up_lines()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = lines.drop_repeated(docs, batches=batches).collect()
    ours = [(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in found]
    assert sorted(ours, key=str) == brute_lines(rows)


def test_lines_with_clashing_columns_and_empty_tables(spark):
    hot = "the very same line that all of these documents hold"
    rows = [(i, hot, 1, "old", 2, "other", "first") for i in range(6)]
    docs = spark.createDataFrame(rows, DOC)
    done = lines.drop_repeated(docs)
    assert done.columns == [c for c in DOC.replace(",", "").split()[::2] if c != "kept"] + [
        "n_lines", "n_dropped", "kept"
    ]
    assert {(r.doc_id, r.kept, r.line, r.id) for r in done.collect()} == {
        (i, hot if i == 5 else "", "other", 2) for i in range(6)
    }
    assert lines.drop_repeated(docs.limit(0)).count() == 0
    databases = [r.namespace for r in spark.sql("SHOW DATABASES").collect()]
    assert not [d for d in databases if d.startswith("line_runs_")]


def test_runs_are_merged_without_a_shuffle(spark):
    index = lines.LineRuns(spark, 2)
    try:
        for k in range(4):
            index.add(spark.createDataFrame([(bytes([i]), 9 - k) for i in range(k, 9)], "line binary, id long"))
            plan = index.merged(index.runs())._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan
            assert [len(level) for level in index.levels] == [[1], [0, 1], [1, 1], [0, 0, 1]][k]
        got = {(bytes(r.line), r.holder) for r in index.repeated().collect()}
        assert got == {(bytes([i]), 9) for i in range(1, 9)}
    finally:
        index.close()


# Negatives


def brute_negatives(rows, n_positives=5, n_negatives=10):
    usable = {}
    for i, vector, label in rows:
        if None in (i, vector, label) or any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = [int(np.floor(256 * float(np.float32(x)))) for x in vector]
        usable[i] = min(usable.get(i, (label, whole)), (label, whole))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a, (label, vector) in usable.items():
        if a % 100:
            continue
        scores = sorted((-score(vector, v), i, own) for i, (own, v) in usable.items() if i != a)
        for p, i, _ in [s for s in scores if s[2] == label][:n_positives]:
            window = [
                (s, j) for s, j, own in scores
                if own != label and 30 * -p <= 100 * -s <= 90 * -p
            ]
            for rank, (s, j) in enumerate(window[:n_negatives], 1):
                out.append((a, i, rank, j, -p, -s))
    return sorted(out)


def mined(spark, rows, **names):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return sorted(map(tuple, negatives.mine(table, lambda i: i % 100 == 0, **names).collect()))


def test_negatives_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [
        (int(i), rng.normal(0.3, 1, 6).round(1).tolist(), int(rng.integers(0, 3)))
        for i in range(0, 1500, 5)
    ]
    rows += [(None, [1.0] * 6, 1), (1, None, 1), (2, [1.0] * 6, None), (3, [1.0, None] * 3, 1)]
    rows += [(4, [float("nan")] * 6, 1), (6, [float("inf")] * 6, 1), (7, [], 1), (8, [1.0], 2)]
    rows += rows[:40] + [(100, [9.0] * 6, 2)]  # repeated rows and ids, ties by rounding
    rows += [(2000 + i, rows[3][1], i % 3) for i in range(1, 90)]  # one vector many times
    found = mined(spark, rows)
    assert found == brute_negatives(rows) and len(found) > 100


def test_negatives_of_few_or_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert mined(spark, [(0, [1.0], 1), (2, [1.0], 1), (3, [0.5], 2)]) == [
        (0, 2, 1, 3, 65536, 32768)
    ]
    with pytest.raises(ValueError, match="scale"):
        mined(spark, [(0, [3e30], 1), (2, [1.0], 1)])


def test_scores_are_exact_whatever_their_size():
    rng = np.random.default_rng(4)
    for bits, dims in ((3, 1), (8, 64), (20, 300), (27, 90)):
        rows = rng.integers(-(2**bits), 2**bits, (50, dims))
        rows[0], rows[1] = 2**bits, -(2**bits)
        largest = int((rows.astype(object) ** 2).sum(axis=1).max())
        residues = negatives.Residues(rows, negatives.small_primes(2 * largest + 1))
        exact = rows[:20].astype(object) @ rows.T.astype(object)
        assert (residues.scores(rows[:20]) == exact).all()
        assert (residues.scores(rows[:20], 5, 9) == exact[:, 5:9]).all()


def test_several_blocks_and_tiles_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(int(i) * 10, rng.normal(1, 1, 5).tolist(), int(i) % 4) for i in range(200)]
    whole = mined(spark, rows)
    monkeypatch.setattr(negatives, "BLOCK_VALUES", 35)
    monkeypatch.setattr(negatives, "TILE_SCORES", 10)
    assert mined(spark, rows) == whole and whole


def test_empty_query_condition(spark):
    table = spark.createDataFrame([(1, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert negatives.mine(table, lambda i: F.lit(False) & (i > 0)).count() == 0
