"""Web archives, nearest neighbours and the pipeline."""

import gzip
import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import DATA
from roadstream.llm import ann, jaccard, quality, samples, toxicity, warc
from roadstream.llm.components import components
from roadstream.llm.queries import ORACLES, QUERIES
from roadstream.operators.sizes import run_folder

PAGES = "page_id long, url string, html string, captured int"


def index_of(spark, rows, **kw):
    folder = f"{run_folder(spark)}/archives"
    warc.write_archives(spark.createDataFrame(rows, PAGES), folder, **kw)
    return warc.capture_index(warc.capture_runs(spark, folder)), folder


def test_archives(spark):
    big, tricky = "é" * 700, "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 40
    rows = [
        (1, "http://a.org/x", big, 0), (9, "http://a.org/x", big, 0), (4, None, big, 0),
        (2, "http://b.org/\r\nX: y", tricky, 0), (3, "https://www.A.org/x#top", None, 0),
        (5, "", "", 0), (6, "http://c.org", "short", 0), (7, "http://c.org", "short", 0),
        (8, "http://d.org", "long " * 100_000, 0), (None, "http://e.org", big, 0),
        (11, "http://f.org", tricky, 0), (11, "http://f.org", tricky, 0),
    ]
    index, folder = index_of(spark, rows, archive_bytes=700)
    found = index.orderBy("position").collect()
    assert [r.position for r in found] == list(range(len(rows)))
    payload = {i: h or "" for i, _, h, _ in rows}
    assert Counter(r.page_id for r in found) == Counter(i for i, _, _, _ in rows)
    for row in found:
        raw = payload[row.page_id].encode()
        assert (row.payload_bytes, row.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in found}
    assert kinds == {
        (1, "revisit", 9), (4, "revisit", 9), (None, "revisit", 9), (2, "revisit", 11),
        *((i, "response", None) for i in (9, 11, 3, 5, 6, 7, 8)),
    }
    keys = [(r.url_key, r.captured, r.page_id or -1) for r in found]
    assert keys == sorted(keys)
    stored = {r.page_id: bytes(r.payload) for r in warc.read_payloads(spark, folder).collect()}
    assert stored[11] == tricky.encode() and stored[8] == payload[8].encode() and stored[1] == b""
    some = index.filter("page_id in (8, 11, 6)")
    picked = warc.payloads_at(spark, folder, some).collect()
    assert Counter((r.page_id, bytes(r.payload)) for r in picked) == Counter(
        (i, payload[i].encode()) for i in (8, 11, 11, 6)
    )


def test_archives_close_at_their_bound(spark):
    """Archives are sequences of gzip members that any reader unpacks."""
    rows = [(i, f"http://a.org/{i}", random.Random(i).randbytes(400).hex(), 0) for i in range(60)]
    folder = f"{run_folder(spark)}/archives"
    pages = spark.createDataFrame(rows, PAGES).coalesce(1)
    warc.write_archives(pages, folder, archive_bytes=5000)
    files = [bytes(r.content) for r in warc._archives(spark, folder).collect()]
    assert len(files) > 5 and max(map(len, files)) <= 5000
    assert sum(gzip.decompress(f).count(b"WARC/1.1\r\n") for f in files) == 60
    for content in files:
        ends = [at + span for at, span, _ in warc.members_of(content)]
        assert ends[-1] == len(content)
        at, span, plain = list(warc.members_of(content))[1]
        assert gzip.decompress(content[at : at + span]) == plain


def test_member_of_a_long_record():
    """The high byte of the length is not zero; an empty member hides it."""
    record = b"x" * (17 << 20)
    packed = warc.member(record)
    assert packed[-1] == 0 and gzip.decompress(packed) == record
    assert [plain for _, _, plain in warc.members_of(packed)] == [record, b""]


def test_stretches():
    rows = [(k, "", 0, *[0] * 6, 0) for k in "abcabdd"]
    assert [[r[0] for r in s] for s in warc.sorted_stretches(iter(rows))] == [
        ["a", "b", "c"],
        ["a", "b", "d", "d"],
    ]
    assert warc.sorted_stretches(iter([])) == []


def test_query_of_pages_with_equal_payloads(spark, tmp_path):
    """The registered query against its SQL, on the given pages and on repeated ones."""
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    copies = pages.select(
        (F.col("page_id") + 100_000).alias("page_id"),
        F.when(F.col("page_id") % 3 > 0, F.concat(F.lit("HTTP://www.X.org:80/"), "url")).alias("url"),
        F.when(F.col("page_id") % 5 > 0, F.repeat("html", F.lit(3))).alias("html"),
    )
    again = copies.withColumn("page_id", F.col("page_id") + 100_000)
    columns = ["page_id", "url", "html"]
    both = pages.select(columns).union(copies).union(again)
    both.write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    for folder, files in ((DATA, f"{DATA}/pages.parquet"), (tmp_path, f"{tmp_path}/pages.parquet/*.parquet")):
        con.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{files}'")
        theirs = con.sql(ORACLES["op2_warc"])
        ours = QUERIES["op2_warc"](spark, str(folder)).select(theirs.columns)
        assert sorted(map(tuple, ours.collect()), key=str) == sorted(theirs.fetchall(), key=str)
    assert sum(row[theirs.columns.index("record_type")] == "revisit" for row in theirs.fetchall()) > 20


def test_archives_of_nothing(spark):
    index, _ = index_of(spark, [])
    assert index.count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [
        sorted(
            ((rng.choice("ab"), str(rng.randrange(3)), rng.choice([None, 1, 2]), *[0] * 6, rng.randrange(9))
             for _ in range(rng.randrange(0, 12))),
            key=warc._sort_key,
        )
        for _ in range(k)
    ]
    merged = list(warc.merge_runs(runs))
    assert merged == sorted((r for run in runs for r in run), key=warc._sort_key)


def test_url_keys():
    assert warc.url_key("https://www.Ex.org:80/A?b#c") == "org,ex)/a?b"
    assert warc.url_key(None) == "" and warc.url_key("ex.org") == "org,ex)/"


def exact_neighbours(ids, x, query, k):
    far = np.sqrt(((x - x[query]) ** 2).sum(axis=1))
    others = [(float(d), int(i)) for d, i in zip(far, ids, strict=True) if i != ids[query]]
    return sorted(others)[:k]


def test_recall(spark):
    """Over several shards, with a vector that a third of all rows share."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 16))
    x[rng.random(1500) < 0.33] = x[0]
    ids = rng.permutation(1500) * 2
    rows = [(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, shard int")
    index = ann.build_index(ann.usable(table), 400)
    assert index.agg(F.sum(F.size("vec_ids"))).first()[0] == 1500
    found = ann.search(index, ann.usable(table).filter("vec_id % 20 = 0"), 10).collect()
    hit = total = 0
    for query in np.flatnonzero(ids % 20 == 0):
        got = sorted((r.rank, r.score, r.vec_id) for r in found if r.query_id == ids[query])
        assert [r for r, _, _ in got] == list(range(1, 11))
        assert [(s, v) for _, s, v in got] == sorted((s, v) for _, s, v in got)
        want = exact_neighbours(ids, x, query, 10)
        hit += len({v for _, _, v in got} & {v for _, v in want})
        total += 10
    assert hit >= 0.95 * total


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]),
            (6, []), (7, [1.0, 1.0]), (8, [1.0, 0.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (7, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.neighbours(table, F.col("vec_id") >= 0, 10).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == [
        (0, 1, 8, 0.0), (0, 2, 7, 1.0), (7, 1, 0, 1.0), (7, 2, 8, 1.0), (8, 1, 0, 0.0), (8, 2, 7, 1.0),
    ]
    assert ann.neighbours(table.limit(0), F.lit(True), 10).count() == 0


def test_components(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7), (60, 61), (60, 61)]
    links = spark.createDataFrame(pairs, "a long, b long")
    found = {r.node: r.label for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90, 60: 60, 61: 60}
    assert components(links.limit(0)).count() == 0


def test_queries(spark):
    pages = {r.page_id: r.html or "" for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    found = QUERIES["op2_warc"](spark, DATA).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in found} == {
        i: (len(h.encode()), hashlib.sha1(h.encode()).hexdigest()) for i, h in pages.items()
    }
    vectors = spark.read.parquet(f"{DATA}/embeddings.parquet").toPandas()
    x, ids = np.stack(vectors.embedding).astype(float), vectors.vec_id.to_numpy()
    near = QUERIES["op3_ann"](spark, DATA).collect()
    hit = 0
    for query in np.flatnonzero(ids % 100 == 0):
        want = {v for _, v in exact_neighbours(ids, x, query, 10)}
        hit += len(want & {r.vec_id for r in near if r.query_id == ids[query]})
    assert hit >= 0.9 * len(near)


def test_pipeline(spark, tmp_path):
    """Each stage against what its operator decides on the stage's own input."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    inputs, texts = [docs], {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, inputs[-1], DATA).write.parquet(str(tmp_path / name))
        inputs.append(spark.read.parquet(str(tmp_path / name)))
    ids = [Counter(r.doc_id for r in i.select("doc_id").collect()) for i in inputs]
    assert all(i.columns == docs.columns for i in inputs[:-1])
    for at, module, modulus, remainder, keep in ((0, toxicity, 4, 2, 0), (1, quality, 5, 0, 1)):
        model = module.fit(inputs[at], labels, samples.id_remainder("doc_id", modulus) != remainder)
        kept = module.classify(inputs[at], model).filter(F.col("predicted") == keep)
        assert ids[at + 1] == Counter(r.doc_id for r in kept.collect())
    groups = jaccard.near_duplicates(inputs[2]).collect()
    assert ids[3] == Counter({r.component_id for r in groups})
    assert set(ids[4]) <= set(ids[3]) and max(ids[4].values()) <= 2
    last = inputs[5].collect()
    assert ids[5] == ids[4] and all(r.decodes and r.n_tokens == len(r.token_ids) for r in last)
    assert all(r.text == texts[r.doc_id] for r in last)
    ran = corpus_pipeline.run(spark, DATA)
    assert Counter(r.doc_id for r in ran.collect()) == ids[5]


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        assert docs.count() == 0


CLASHES = (
    "n_tokens token_ids decodes back size times target source_size taken copy digest _text _copy "
    "_key _place _limit _t _both node sketch key rank score predicted component_id n_shingles _label"
).split()


def test_pipeline_with_other_columns_and_odd_rows(spark):
    """Columns named like helpers and outputs come through unchanged, odd rows too."""
    words = [" ".join(f"w{(7 * i + j * j) % 301}" for j in range(30 + i)) for i in range(40)]
    rows = [(i, t, "ab"[i % 2]) for i, t in enumerate(words)]
    rows += [(50, None, "a"), (51, "", None), (52, "x" * 200_000, "b"), (53, "long " * 50_000, "a")]
    rows += [(None, words[0] + " more", "a"), (None, None, None)] + rows[:2] * 2
    given = [(*row, *(f"{c} of {row[0]}" for c in CLASHES)) for row in rows]
    schema = ", ".join(f"`{c}` string" for c in CLASHES)
    docs = spark.createDataFrame(given, f"doc_id long, text string, source string, {schema}")
    stored = docs
    for name, stage in corpus_pipeline.STAGES:
        stored = jaccard.stored(stage(spark, stored, DATA))
        if name != "bpe":
            assert stored.columns == docs.columns
    assert sorted(stored.columns) == sorted(docs.columns)
    kept = [c for c in CLASHES if c not in ("n_tokens", "token_ids", "decodes")]
    out = stored.collect()
    assert out and all(r[c] == f"{c} of {r.doc_id}" for r in out for c in kept)
    assert all(r.decodes and r.n_tokens == len(r.token_ids) for r in out)
    texts = {row[0]: row[1] for row in rows if row[0] is not None}
    assert all(r.text == texts[r.doc_id] for r in out if r.doc_id is not None)


def test_sample_is_bounded_with_repeated_ids(spark):
    docs = spark.createDataFrame(
        [(i % 20, f"text {i}") for i in range(400)], "doc_id long, text string"
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    found = samples.labelled_sample(docs, samples.class_labels(labels, "toxic"), 8).collect()
    assert len(found) == len({r.doc_id for r in found}) == 16
    least = {i: min(f"text {j}" for j in range(i, 400, 20)) for i in range(20)}
    assert all(r.text == least[r.doc_id] and r._label == r.doc_id % 2 for r in found)


def test_queries_stream_past_shards_that_move_once(spark):
    """Many batches of queries, several shards and lengths: no copy of the index, same recall."""
    rng = np.random.default_rng(17)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(3000)]
    rows += [(5000 + i, rng.normal(size=7).tolist()) for i in range(600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = ann.stored(ann.usable(table))
    index = ann.stored(ann.build_index(vectors, 500))
    asked = vectors.filter("vec_id % 2 = 0")
    near = ann.search(index, asked, 10)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("MapInArrow") == 1
    found = {}
    for r in near.collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert len(found) == 1800
    hit = 0
    for part in (rows[:3000], rows[3000:]):
        x, ids = np.array([v for _, v in part]), np.array([i for i, _ in part])
        for i in range(0, len(part), 20):
            far = ((x - x[i]) ** 2).sum(axis=1)
            far[i] = np.inf
            hit += len(set(ids[np.argsort(far)[:10]].tolist()) & found[ids[i]])
    assert hit >= 0.95 * 10 * (150 + 30)
