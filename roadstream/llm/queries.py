"""The registered queries of the package: each operator over its whole table."""

from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.llm import (
    ann,
    bpe,
    jaccard,
    lines,
    lm,
    mixing,
    negatives,
    periodic,
    quality,
    samples,
    syncmers,
    token_counts,
    toxicity,
    warc,
)
from roadstream.operators.sizes import run_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 1024


def query(make: Query) -> Query:
    """Register under the function's name."""
    QUERIES[make.__name__] = make
    return make


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, VOCABULARY).select(
        "doc_id",
        bpe.n_tokens("ids").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count(docs, VOCABULARY).select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


def trained(spark, sf_dir, module, docs, modulus, held_out):
    """Model of ``module`` on the labelled rows that are not held out."""
    in_training = samples.id_remainder("doc_id", modulus) != held_out
    return module.fit(docs, table(spark, sf_dir, "labels"), in_training)


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = trained(spark, sf_dir, toxicity, docs, 4, 2)
    held_out = (samples.id_remainder("doc_id", 4) == 2).alias("held_out")
    return toxicity.classify(docs, model).select("doc_id", held_out, "score", "predicted")


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = trained(spark, sf_dir, quality, docs, 5, 0)
    held_out = (samples.id_remainder("doc_id", 5) == 0).alias("held_out")
    return quality.classify(docs, model).select("doc_id", held_out, "score", "predicted")


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", "times"
    )


ORACLES["op6_mixing"] = r"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '') AS k,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place
  FROM documents),
s AS (SELECT k, sum(size) AS n FROM d GROUP BY k),
w AS (
  SELECT k, n, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY k = '', k) - 1) % 3 + 1]::DOUBLE AS w
  FROM s),
r AS (
  SELECT *, 2.0::DOUBLE * n AS cap, 2.0::DOUBLE * n / w AS ratio,
    (1.5::DOUBLE * sum(n) OVER ()
      - coalesce(sum(2.0::DOUBLE * n) OVER (ORDER BY 2.0::DOUBLE * n / w, k
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY 2.0::DOUBLE * n / w, k
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lv
  FROM w),
t AS (
  SELECT k, n, least(w * (SELECT arg_min(lv, (ratio, k)) FROM r WHERE lv <= ratio), cap) AS target
  FROM r),
b AS (
  SELECT *, CASE WHEN n > 0 THEN floor(target / n)::BIGINT ELSE 0 END AS times FROM t),
p AS (SELECT k, place, sum(size) AS ps FROM d GROUP BY k, place),
c AS (
  SELECT p.k, p.place, p.ps, target - times * n AS budget,
    sum(p.ps) OVER (PARTITION BY p.k ORDER BY p.place) AS upto
  FROM p JOIN b ON p.k = b.k),
x AS (
  SELECT k, place, budget > 0 AND (upto <= budget OR
    (upto - ps <= budget AND ps > 0 AND 2 * (budget - (upto - ps)) >= ps)) AS more
  FROM c)
SELECT d.doc_id, d.size::BIGINT AS size, b.n::BIGINT AS source_size,
  round(b.target, 6) AS target,
  (d.size * (b.times + x.more::INT))::BIGINT AS taken,
  (b.times + x.more::INT)::BIGINT AS times
FROM d JOIN b ON d.k = b.k JOIN x ON x.k = d.k AND x.place = d.place
"""


@query
def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLES["op5_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
u AS (SELECT r, len(w) AS n, unnest(range(len(w))) AS i, unnest(w) AS word FROM w),
f AS (
  SELECT r, n, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o,
    lead(word, 3) OVER o, lead(word, 4) OVER o) AS shingle
  FROM u WINDOW o AS (PARTITION BY r ORDER BY i)),
d AS (SELECT DISTINCT r, shingle FROM f WHERE i < greatest(n - 4, 1)),
k AS (SELECT r, count(*) AS n, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS s FROM d GROUP BY r),
s AS (SELECT w.r, doc_id, coalesce(n, 0) AS n, s FROM w LEFT JOIN k ON w.r = k.r),
c AS (SELECT s, min(doc_id) AS id, min(r) AS r, max(n) AS n FROM s WHERE n > 0 GROUP BY s),
x AS (SELECT c.id, c.n, shingle FROM c JOIN d ON c.r = d.r),
links AS (
  SELECT one.id AS a, other.id AS b
  FROM x AS one JOIN x AS other ON one.shingle = other.shingle AND one.id <> other.id
  GROUP BY one.id, one.n, other.id, other.n
  HAVING 100 * count(*) >= 75 * (one.n + other.n - count(*))),
reached AS (
  SELECT id AS a, id AS b FROM c
  UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT s.doc_id, s.n::BIGINT AS n_shingles, coalesce(component_id, s.doc_id) AS component_id
FROM s LEFT JOIN c ON s.s = c.s LEFT JOIN least ON least.a = c.id
"""


@query
def op7_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    edited = syncmers.with_edit(syncmers.with_next(docs))
    return edited.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        syncmers.as_text("anchors").alias("fingerprint"),
        syncmers.as_text("edited_anchors").alias("edited_fingerprint"),
        syncmers.likeness("anchors", "edited_anchors").alias("near_edited"),
        syncmers.likeness("anchors", "next_anchors").alias("near_next"),
    )


@query
def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = samples.id_remainder("doc_id", 7) == 2
    scored = lm.fit(docs, ~held_out).score(docs)
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return scored.select("doc_id", held_out.alias("held_out"), *columns)


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{run_folder(spark)}/archives"
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    index = warc.capture_index(warc.capture_runs(spark, folder))
    columns = ["payload_bytes", "payload_digest", "record_type", "refers_to"]
    return index.select("page_id", *columns, "url_key", "captured", "position")


ORACLES["op2_warc"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, lower(coalesce(url, '')) AS u FROM pages),
d AS (
  SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
    split_part(CASE WHEN contains(u, '://') THEN substr(u, instr(u, '://') + 3) ELSE u END,
      '#', 1) AS rest
  FROM p),
h AS (
  SELECT *, split_part(regexp_replace(split_part(rest, '/', 1), '^www\.', ''), ':', 1) AS host,
    CASE WHEN contains(rest, '/') THEN substr(rest, instr(rest, '/')) ELSE '/' END AS path,
    CASE WHEN payload_bytes >= 1000
      THEN max(page_id) OVER (PARTITION BY payload_digest) END AS first
  FROM d),
c AS (
  SELECT *, CASE WHEN rest = '' THEN ''
      ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || path END AS url_key,
    strftime(TIMESTAMP '2024-01-01' + to_seconds(coalesce(page_id, 0) % 1000000000),
      '%Y-%m-%dT%H:%M:%SZ') AS captured,
    first IS NOT NULL AND page_id IS DISTINCT FROM first AS again
  FROM h)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to, url_key, captured,
  row_number() OVER (ORDER BY url_key, captured, page_id NULLS FIRST) - 1 AS position
FROM c
"""


@query
def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.neighbours(vectors, F.col("vec_id") % 100 == 0, 10)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Texts of one id hash in ten with their words from some place on repeating."""

    @F.arrow_udf("string")
    def edited(texts: pa.Array, id_hashes: pa.Array) -> pa.Array:
        given = zip(texts.to_pylist(), id_hashes.to_pylist(), strict=True)
        return pa.array(
            [t if h % 10 else periodic.repeated_tail(t, h // 10) for t, h in given], pa.string()
        )

    id_hash = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.withColumn("text", edited("text", id_hash))


@query
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.with_runs(with_planted_runs(docs))
    runs = F.col("periodic.runs")
    best = found.withColumn("best", periodic.greatest(runs))
    exponent = F.floor(1000 * F.col("best.length") / F.col("best.period"))
    return best.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        exponent.cast("long").alias("exponent_milli"),
        F.sha2(periodic.as_lines(runs).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("periodic.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


# CRC-32 is computed from its polynomial, bit by bit. Pairs of equal words at most a quarter
# of a text apart form islands; an island of distance q is a stretch with period q, and of
# equal stretches the least period is the run's.
ORACLES["op11_runs"] = r"""
WITH h AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(text, '[^ 	-
]+'), []) AS w,
    xor(list_reduce(list_concat([4294967295],
      list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: coalesce(ascii(c), 0))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)),
      4294967295) AS h
  FROM documents),
e AS (SELECT *, len(w) AS n, h // 10 AS g FROM h),
f AS (
  SELECT *, g % greatest(n, 1) AS a FROM e),
d AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i
      ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1])
    ELSE w END AS w
  FROM f),
x AS (SELECT r, n, unnest(range(n)) AS i, unnest(w) AS word FROM d),
pairs AS (
  SELECT one.r, one.i, other.i - one.i AS q
  FROM x AS one JOIN x AS other
    ON one.r = other.r AND one.word = other.word AND one.i < other.i
      AND 4 * (other.i - one.i) <= one.n),
islands AS (
  SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs),
stretches AS (
  SELECT r, q, min(i) AS s, count(*) + q AS len FROM islands GROUP BY r, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT r, s, len, min(q) AS q FROM stretches GROUP BY r, s, len),
best AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY len::DOUBLE / q DESC, s, q) AS k,
    string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) OVER (PARTITION BY r) AS t,
    count(*) OVER (PARTITION BY r) AS n_runs
  FROM runs),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM x
  WHERE NOT EXISTS (SELECT 1 FROM runs WHERE runs.r = x.r AND x.i >= s + q AND x.i < s + len)
  GROUP BY r)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start,
  len::BIGINT AS length, q::BIGINT AS period, (1000 * len // q)::BIGINT AS exponent_milli,
  sha256(coalesce(best.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN best ON best.r = d.r AND k = 1 LEFT JOIN kept ON kept.r = d.r
"""


@query
def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return lines.drop_repeated(docs).select("doc_id", "n_lines", "n_dropped", kept)


ORACLES["op13_lines"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS own
  FROM documents),
x AS (SELECT r, doc_id, unnest(range(len(own))) AS i, unnest(own) AS line FROM d),
k AS (
  SELECT *, translate(
    regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM x),
repeated AS (
  SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40
  GROUP BY key
  HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 5),
marked AS (
  SELECT k.*, repeated.key IS NOT NULL AND k.doc_id IS DISTINCT FROM holder AS gone
  FROM k LEFT JOIN repeated ON repeated.key = k.key)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines,
  count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""


@query
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    label = turned.otherwise(F.col("label"))
    return negatives.mine(vectors, lambda vec_id: vec_id % 100 == 0, label=label)


ORACLES["op12_negatives"] = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.id AS anchor_id, r.id, a.label = r.label AS same,
    list_dot_product(a.c, r.c)::BIGINT AS score
  FROM v AS a, v AS r WHERE a.id % 100 = 0 AND r.id <> a.id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
  (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id))::INTEGER
    AS rank
FROM positives AS p JOIN scores AS s ON s.anchor_id = p.anchor_id AND NOT same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 10
"""
