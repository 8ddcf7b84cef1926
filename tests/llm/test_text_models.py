"""Classifiers, language model, fingerprints and mixing."""

import hashlib
import math
import random
import re
import struct
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import DATA
from roadstream.llm import lm, mixing, quality, samples, syncmers, toxicity, words
from roadstream.llm.queries import ORACLES, QUERIES

SF = DATA.replace("0.001", "0.01")
NO_DOCS = "doc_id long, text string"


def made_up(n=600, seed=1):
    rng = random.Random(seed)
    syllables = ["ba", "do", "ki", "lu", "me", "no", "ra", "si", "tu"]
    rows, labels = [], []
    for i in range(n):
        own = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60))]
        if toxic := i % 4 == 0:
            own[rng.randrange(len(own))] = "zyxgrub" + rng.choice(syllables)
        if poor := i % 5 == 1 and not toxic:
            own = [own[0]] * len(own)
        rows.append((i, " ".join(own)))
        labels.append((i, int(not poor), int(toxic)))
    return rows, labels


@pytest.mark.parametrize("module, label, column", [(toxicity, "toxic", 2), (quality, "quality", 1)])
def test_classifier_holds_out(spark, module, label, column):
    rows, labels = made_up()
    extra = [(900, None), (901, ""), (902, "ba do " * 30_000), (0, rows[0][1]), (None, "ba do")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows + extra], NO_DOCS + ", score string")
    bad = [(None, 1, 1), (901, None, None), (902, 7, 7), (903, 1, 0)]
    known = spark.createDataFrame(labels + bad, "doc_id long, quality int, toxic int")
    model = module.fit(docs, known, samples.id_remainder("doc_id", 4) != 2)
    found = module.classify(docs, model).collect()
    assert len(found) == len(rows) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    truth = {x[0]: x[column] for x in labels}
    out = [r for r in found if r.doc_id in truth and crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 0.97 * len(out)
    same = [r.score for r in found if r.doc_id == 0]
    assert same[0] == same[1]
    again = module.classify(docs, module.fit(docs, known, samples.id_remainder("doc_id", 4) != 2))
    assert {(r.doc_id, r.score) for r in again.collect()} == {(r.doc_id, r.score) for r in found}


def test_toxicity_keeps_every_sure_bucket():
    counts = np.zeros((2, 1 << toxicity.BITS))
    counts[1, :5000] = 20 + np.arange(5000) % 70
    ratio = toxicity.log_ratios(counts, (100, 100))
    assert (ratio[:5000] > 0).all() and not ratio[5000:].any()


def test_logistic_in_pieces():
    """Cutting the rows into pieces changes nothing; the weights tell the classes apart."""
    rng = np.random.default_rng(9)
    sizes, label = rng.integers(0, 6, 200).astype(np.int32), rng.integers(0, 2, 200).astype(np.int32)
    n = int(sizes.sum())
    column = np.where(np.repeat(label, sizes) > 0, rng.integers(0, 6, n), rng.integers(4, 10, n))
    value, scale = rng.integers(1, 4, n), np.linspace(0.5, 2, 10)

    def piece(a, b):
        upto = np.concatenate([[0], np.cumsum(sizes)])
        own = slice(upto[a], upto[b])
        return toxicity.Piece(sizes[a:b], column[own], value[own], label[a:b])

    whole = toxicity.logistic([piece(0, 200)], scale)
    cut = toxicity.logistic([piece(0, 70), piece(70, 71), piece(71, 200)], scale)
    assert np.allclose(whole[0], cut[0]) and abs(whole[1] - cut[1]) < 1e-8
    assert (whole[0][:4] > 0).all() and (whole[0][6:] < 0).all()


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifier_without_two_classes(spark, module, label):
    docs = spark.createDataFrame([(1, "a"), (2, None)], NO_DOCS)
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    one = spark.createDataFrame([(1, 1), (1, 0)], f"doc_id long, {label} int")
    for labels, score in ((none, 0.5), (one, 2 / 3)):
        model = module.fit(docs, labels, F.lit(True))
        assert all(abs(r.score - score) < 1e-9 for r in module.classify(docs, model).collect())
    model = module.fit(docs.limit(0), none, F.lit(True))
    assert module.classify(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("name, label, least", [("op4_toxicity", "toxic", 0.85), ("op9_quality", "quality", 0.95)])
def test_classifier_queries(spark, name, label, least):
    found = QUERIES[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    out = [r for r in found if r.held_out]
    modulus, remainder = {"toxic": (4, 2), "quality": (5, 0)}[label]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % modulus == remainder) for r in found)
    assert sum(r.predicted == r[label] for r in out) >= least * len(out)


def test_tables_of_a_quality_model():
    """Boosting finds an effect of one feature and one that only a pair shows."""
    rng = np.random.default_rng(4)
    x = rng.random((4000, 3))
    label = ((x[:, 0] > 0.7) | ((x[:, 1] > 0.5) != (x[:, 2] > 0.5))).astype(float)
    model = quality.boost(x, label, 0.0)
    assert ((model.score(x) > 0.5) == label).mean() > 0.95
    assert (1, 2) in model.pairs


def plain_tokens(text):
    lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + ["\n"]


@pytest.mark.parametrize("most", [1 << 20, 300])
def test_language_model(spark, monkeypatch, most):
    """Exact figures with all words broadcast, and with most of them joined."""
    monkeypatch.setattr(lm.frequent_words, "__defaults__", (most,))
    read = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    docs = read.union(spark.createDataFrame([(9001, None), (9002, ""), (9003, "q " * 50_000)], NO_DOCS))
    texts = {r.doc_id: plain_tokens(r.text) for r in docs.collect()}
    c = Counter(t for i, own in texts.items() if crc32(str(i).encode()) % 7 != 2 for t in own)
    below = math.log10(sum(c.values()) + len(c) + 1)
    found = lm.score(docs, samples.id_remainder("doc_id", 7) != 2, 1 << 24).collect()
    assert len(found) == len(texts)
    for row in found:
        own = texts[row.doc_id]
        base = sum(math.log10(c[t] + 1) - below for t in own)
        assert (row.n_tokens, row.n_known) == (len(own), sum(c[t] > 0 for t in own))
        assert row.train_tokens == sum(c.values()) and abs(row.base_score - base) < 1e-6 * len(own)
        assert row.score < 0
    out = [r for r in found if crc32(str(r.doc_id).encode()) % 7 == 2]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


@pytest.mark.parametrize("top_bits", [1 << 24, 1 << 18, 1])
def test_language_model_holds_every_pair(spark, top_bits):
    """However small a segment or the broadcast filter is, no count level is left out."""
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{rng.randrange(4000)}" for _ in range(150))) for i in range(300)]
    tokens = {i: plain_tokens(t) for i, t in rows}
    c, starts = Counter(), 0
    for i in range(200):
        c.update(tokens[i])
        c.update(zip(tokens[i], tokens[i][1:]))
        starts += 1
        c[(None, tokens[i][0])] += 1
    c[None], words_only = starts, [k for k in c if isinstance(k, str)]
    total = sum(c[w] for w in words_only) + len(words_only) + 1

    def held(key):
        return float(lm.level_count(lm.level(np.array([c[key]])))[0]) if c[key] else 0.0

    docs = spark.createDataFrame(rows, NO_DOCS)
    for r in lm.score(docs, F.col("doc_id") < 200, 1 << 14, top_bits).collect():
        want, before = 0.0, None
        for t in tokens[r.doc_id]:
            both = min(held((before, t)), held(t), held(before))
            plain = lm.SMOOTHING * (held(t) + 1) / total
            want += math.log10((both + plain) / (held(before) + lm.SMOOTHING))
            before = t
        assert abs(r.score - want) < 0.02 * abs(want), r.doc_id


def test_stored_model_scores_new_texts(spark):
    """A model is fitted once; broadcast levels and those of segments agree."""
    rng = random.Random(13)
    rows = [(i, " ".join(f"w{min(rng.randrange(900), rng.randrange(900))}" for _ in range(120))) for i in range(300)]
    docs = spark.createDataFrame(rows[:200], NO_DOCS)
    new = spark.createDataFrame(rows[200:] + [(900, None), (901, "zz " * 30_000)], NO_DOCS)
    models = [lm.fit(docs, F.lit(True), 1 << 20, bits) for bits in (1 << 26, 1 << 16)]
    assert (models[0].least <= 1).all() and (models[1].least > 1).all()
    found = [{r.doc_id: r.score for r in m.score(new).collect()} for m in models]
    assert set(found[0]) == set(range(200, 300)) | {900, 901}
    assert all(abs(found[0][i] - found[1][i]) < 0.02 * abs(found[0][i]) for i in found[0])
    again = {r.doc_id: r.score for r in models[1].score(new.repartition(5)).collect()}
    assert again == pytest.approx(found[1])


def test_repeated_rows_score_alike_in_several_parts(spark):
    rows = [(i, f"some words {i} {i % 7}") for i in range(50)]
    docs = spark.createDataFrame(rows + [(7, "the same row again and again")] * 3000, NO_DOCS)
    spread = docs.repartition(8)
    found = lm.score(spread, F.lit(True), 1 << 16, 1 << 12).collect()
    assert len(found) == 3050
    assert len({r.score for r in found if r.doc_id == 7 and r.n_tokens == 7}) == 1
    part = F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(lm.LEAST_SEGMENTS))
    largest = spread.groupBy(part.alias("p")).count().agg(F.max("count")).first()[0]
    assert largest < 2000


def test_language_model_without_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], NO_DOCS)
    none = lm.score(docs, F.lit(False), 1 << 20).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in none] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert lm.score(docs.limit(0), F.lit(True), 1 << 20).count() == 0


@pytest.mark.parametrize("bits, whole", [(1 << 20, True), (1 << 17, False)])
def test_filter_levels(bits, whole):
    """A held n-gram has its level or, by chance, a higher one; the rarest give way."""
    rng = np.random.default_rng(6)
    keys = words.mixed(np.arange(20_000, dtype=np.uint64))
    counts = rng.geometric(0.05, len(keys))
    segment, sub = lm.split_key(keys, 4)
    built = [lm.build_segment(sub[segment == s], counts[segment == s], bits) for s in range(4)]
    parts = [own for own, _ in built]
    assert all((least <= 1) == whole for _, least in built)
    table = np.frombuffer(b"".join(parts), np.uint8)
    found, true = lm.probe(keys, table, 4), lm.level(counts)
    for s in range(4):
        own, missing = segment == s, (segment == s) & (found < true)
        assert missing.any() != whole
        rarer = own & (true <= true[missing].max(initial=0))
        assert (found[own & ~rarer] >= true[own & ~rarer]).all()
        assert whole or (found[rarer] < true[rarer]).mean() > 0.6
    other = lm.probe(words.mixed(np.arange(1 << 40, (1 << 40) + 5000, dtype=np.uint64)), table, 4)
    assert (other > 0).mean() < (0.01 if whole else 0.25)
    assert lm.level_count(np.array([0, 1])).tolist() == [0, 1]


def brute_edits(texts):
    for i, text in enumerate(texts):
        cut = len(text) // 4
        yield len(text), text[: len(text) - cut] + texts[(i + 1) % len(texts)][:cut]


def test_fingerprints_and_edits(spark):
    rng = random.Random(7)
    texts = ["", "one", "日本語 😀 é", "x" * 90_000, "a b c d e f g h"] + [
        " ".join(rng.choices(["ab", "cd", "ef", "gh", "ij", "kl"], k=rng.randrange(0, 90))) for _ in range(60)
    ]
    rows = [(5 * i, t or None, 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, NO_DOCS + ", anchors int").repartition(5)
    found = syncmers.with_edit(syncmers.with_next(docs.drop("anchors")))
    got = {r.doc_id: r for r in found.withColumns(
        {"f": syncmers.as_text("anchors"), "near": syncmers.likeness("anchors", "edited_anchors")}
    ).collect()}
    assert len(got) == len(texts)
    for i, (n, edited) in enumerate(brute_edits(texts)):
        row = got[5 * i]
        assert (len(row.text), row.edited) == (n, edited)
        assert row.next_text == texts[(i + 1) % len(texts)] and 0 <= row.near <= 1
        assert row.next_anchors == got[5 * ((i + 1) % len(texts))].anchors
    assert got[0].f == "" and got[5].f.startswith("0:")
    one = spark.createDataFrame([(3, "a b")], NO_DOCS)
    assert syncmers.with_next(one).first().next_text == "a b"
    assert syncmers.with_next(one.limit(0)).count() == 0
    ids = spark.createDataFrame([(None, "n"), (1, "b"), (1, "a"), (1, "a")], NO_DOCS)
    chain = sorted((r.doc_id or 0, r.text, r.next_text) for r in syncmers.with_next(ids).collect())
    assert chain == [(0, "n", "a"), (1, "a", "a"), (1, "a", "b"), (1, "b", "n")]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 101])
def test_number_below(spark, n):
    cuts = [3 * i for i in range(n)]
    found = spark.range(-2, 3 * n + 3).select("id", syncmers.number_below(F.col("id"), cuts).alias("n"))
    assert all(r.n == sum(c < r.id for c in cuts) for r in found.collect())


def test_anchors_are_free_of_context(spark):
    rng = random.Random(8)
    middle = " ".join(f"m{rng.randrange(10**6)}" for _ in range(80))
    texts = [middle, "before it " + middle + " after", "quite other words " * 9 + middle]
    docs = spark.createDataFrame(list(enumerate(texts)), NO_DOCS)
    found = docs.select("doc_id", syncmers.anchors("text").alias("anchors"))
    hashes = [{a.hash for a in r.anchors} for r in found.orderBy("doc_id").collect()]
    assert hashes[0] and hashes[0] <= hashes[1] and hashes[0] <= hashes[2]
    pairs = syncmers.positional_matches(found, found).filter("doc_id = 0 and other_id = 1").collect()
    assert max(pairs, key=lambda r: r.n).shift == 2


def test_short_texts_have_anchors(spark):
    """Only texts without units are without anchors, so unlike texts are never called equal."""
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(6 + i % 5)) for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), NO_DOCS)
    found = syncmers.with_next(docs).select(
        F.size("anchors").alias("n"), syncmers.likeness("anchors", "next_anchors").alias("near")
    )
    assert all(r.n > 0 and r.near == 0 for r in found.collect())
    none = spark.createDataFrame([(1, None), (2, " ")], NO_DOCS)
    row = syncmers.with_next(none).select(syncmers.likeness("anchors", "next_anchors")).first()
    assert row[0] == 1.0


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def chain(numbers, seed=42):
    """xxhash64 of several longs: each one's hash is the seed of the next."""
    for n in numbers:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", n), seed)
    return signed(seed)


def brute_anchors(text, k=6, s=2):
    units = re.findall(r"[^\x20\x09-\x0D]{1,12}", text)
    h = [signed(xxhash.xxh64_intdigest(u.encode(), 42)) for u in units]
    low = 0xFFFFFFFF
    if len(h) < k:
        return [(0, chain(h) & low)] if h else []
    g = [chain(h[i : i + s]) for i in range(len(h) - s + 1)]
    last = k - s
    code = lambda i: chain([g[i + j] for j in (*range(0, last, s), last)])
    starts = range(len(g) - last)
    kept = [i for i in starts if min(g[i : i + last + 1]) in (g[i], g[i + last])]
    kept = kept or [min((code(i), i) for i in starts)[1]]
    return [(i, code(i) & low) for i in kept]


def brute_likeness(a, b):
    if not a and not b:
        return 1.0
    first = [{}, {}]
    for found, own in zip(first, (a, b), strict=True):
        for pos, code in own:
            found.setdefault(code, pos)
    common = sorted(set(first[0]) & set(first[1]))
    shifts = {first[1][c] - first[0][c] for c in common[:8]} | {0}
    most = max(len({(p + s, c) for p, c in a} & set(b)) for s in shifts)
    return 2 * most / (len(a) + len(b))


def test_likeness_is_positional(spark):
    rng = random.Random(14)
    one, two = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(200)) for _ in range(2))
    pairs = [
        (f"{one} {two}", f"{two} {one}", 0.3, 0.6),  # halves swapped
        (one, f"{one} {one}", 0.5, 0.75),  # twice
        (f"{one} {two}", f"{one} other words here", 0.5, 0.75),  # an unchanged first half
        (one, f"in front {one}", 0.95, 1.0),  # the whole, moved
        (one, one, 1.0, 1.0),
        (one, two, 0.0, 0.0),
        ("a b " * 300, "a b " * 300, 1.0, 1.0),  # few hashes, very often
        ("", "", 1.0, 1.0),
        ("", one, 0.0, 0.0),
    ]
    docs = spark.createDataFrame([(i, *p[:2]) for i, p in enumerate(pairs)], "i int, a string, b string")
    anchored = docs.select("i", syncmers.anchors("a").alias("a"), syncmers.anchors("b").alias("b"))
    for r in anchored.select("i", "a", "b", syncmers.likeness("a", "b").alias("near")).collect():
        x, y, low, high = pairs[r.i]
        assert [tuple(t) for t in r.a] == brute_anchors(x)
        assert low <= r.near <= high and r.near == pytest.approx(
            brute_likeness(brute_anchors(x), brute_anchors(y))
        )


def test_fingerprint_query(spark):
    docs = sorted(
        (r.doc_id, r.text or "") for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()
    )
    want = {i: e for (i, _), e in zip(docs, brute_edits([t for _, t in docs]), strict=True)}
    found = QUERIES["op7_syncmers"](spark, DATA).collect()
    assert len(found) == len(docs)
    for row in found:
        n, edited = want[row.doc_id]
        assert (row.n_chars, row.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
    texts = [t for _, t in docs]
    for i, (doc_id, text) in enumerate(docs):
        row = next(r for r in found if r.doc_id == doc_id)
        own, other = brute_anchors(text), brute_anchors(texts[(i + 1) % len(texts)])
        changed = brute_anchors(want[doc_id][1])
        written = [" ".join(f"{p}:{c:x}" for p, c in x) for x in (own, changed)]
        assert [row.fingerprint, row.edited_fingerprint] == written
        near = [brute_likeness(own, x) for x in (changed, other)]
        assert [row.near_edited, row.near_next] == pytest.approx(near)
    assert np.mean([r.near_edited for r in found]) > 0.6 > 0.1 > np.mean([r.near_next for r in found])


def oracle(documents):
    con = duckdb.connect()
    con.register("documents", documents)
    return sorted(con.sql(ORACLES["op6_mixing"]).fetchall(), key=str)


def mixed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    found = mixing.mix(docs)
    out = found.select("doc_id", "size", "source_size", F.round("target", 6), "taken", "times").collect()
    return found, sorted((tuple(r) for r in out), key=str)


def test_mixing(spark):
    rng = random.Random(9)
    rows = [
        (i, "w " * rng.randrange(0, 40), rng.choice(["hot"] * 9 + ["b", "c", "d", "é", "", None]), "x")
        for i in range(900)
    ] + [(None, "a b c", "b", "x"), (5000, None, "c", "x"), (5001, "", "empty", "x"), (7, "w w", "hot", "x"),
         (6000, "long " * 20_000, "d", "x")]
    found, out = mixed(spark, rows)
    import pandas as pd

    frame = pd.DataFrame(rows, columns=["doc_id", "text", "source", "size"])
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    assert out == oracle(frame)
    assert out == mixed(spark, rows[::-1])[1]
    total, per_source = sum(r[1] for r in out), {}
    for row in found.collect():
        own = per_source.setdefault(row.source, [row.source_size, row.target, 0, 0])
        own[2] += row.taken
        own[3] = max(own[3], row.size)
        assert row.times <= 2 and row.taken == row.size * row.times
    assert abs(sum(t for _, t, _, _ in per_source.values()) - 1.5 * total) < 1e-6 * total
    for size, target, taken, largest in per_source.values():
        assert target <= 2 * size + 1e-6 and abs(taken - target) <= largest
    assert mixing.repeated(found).count() == sum(r.times for r in found.collect())
    assert mixed(spark, [(1, None, None, None)])[1] == [(1, 0, 0, 0.0, 0, 0)]
    # A source that whole takes satisfy: its documents without words are taken twice, too.
    rows = [(i, "w " * (i % 50 == 0), "b" if i < 300 else "a", "x") for i in range(600)]
    rows += [(1000 + i, "w " * 900, "a", "x") for i in range(4)]
    found = mixed(spark, rows)[0].filter("source = 'b'")
    assert [r.times for r in found.select("times").distinct().collect()] == [2]
    assert mixed(spark, [])[1] == []


def test_word_scores_are_sums_of_buckets():
    rng = random.Random(21)
    weights = np.random.default_rng(21).normal(size=1 << toxicity.BITS)
    own = ["".join(rng.choices("abcxyz09!é中", k=rng.randint(1, 12))) for _ in range(2000)]
    own += ["a", "z" * 5000, "é"]
    found = toxicity.word_scores(own, weights)
    assert found == pytest.approx([weights[toxicity.buckets(w)].sum() for w in own])
    assert toxicity.word_scores([], weights) == []
