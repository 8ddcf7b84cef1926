"""Repeated lines dropped from documents, by levelled sorted runs of line hashes.

A line's key is the line without white space at its ends, A-Z in lower case. Keys of
at least ``least_chars`` code points that at least ``least_docs`` documents hold lose
their lines, except in the largest document id that holds them.

The index of keys is a set of sorted runs: tables bucketed and sorted by the key's hash,
with the number of documents and the largest id of each key. Documents come in batches
of falling ids. A key is settled when enough documents of earlier, and so larger, ids
hold it: its holder is known and no more needs counting. Each batch's keys are
merge-anti-joined with the settled keys of the runs, bucket by bucket, and what is left
is written as a run of its own. Two runs of a level are merged into one of the next level,
which adds up the documents of each key, and dropped. A last merge of all runs gives the
repeated keys. Every row is counted; no size is special.

Keys are compared by 128-bit hashes. A key held by very many documents is counted
before it is shuffled, and where lines meet the repeated keys, Spark splits its rows.

Rows: a null or empty text is one empty line. Rows that repeat an id are one document for
counts, and each gets its result; rows with null ids are together one document, below all
others. A line repeated inside a document counts once and goes with all its copies. Very
long texts stay whole in one row. Other columns stay, whatever their names; the output
columns replace those of the same name. An empty table stays empty.
"""

import uuid
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.llm.store import small_batches
from roadstream.operators.sizes import run_folder

SPACE = b" \t\n\x0b\x0c\r"
OUTPUTS = ("n_lines", "n_dropped", "kept")


def line_hash(line: bytes, least_chars: int) -> bytes | None:
    """Hash of a line's key; None for a short one."""
    key = line.strip(SPACE).lower()
    if len(key) < least_chars:
        return None
    if len(key) < 4 * least_chars and not key.isascii() and len(key.decode()) < least_chars:
        return None
    return blake2b(key, digest_size=16).digest()


def line_keys(docs: DataFrame, doc_id: str, text: str, least_chars: int) -> DataFrame:
    """One row of ``line`` (hash) and ``id`` for each different key of each row."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lines = [], []
            for own, t in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                found = {line_hash(line, least_chars) for line in (t or "").encode().split(b"\n")}
                found.discard(None)
                lines += found
                ids += [own] * len(found)
            columns = [pa.array(lines, pa.binary()), pa.array(ids, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["line", "id"])

    given = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return given.mapInArrow(keys, "line binary, id long")


class LineRuns:
    """Levels of sorted runs of line hashes, in a database below the shared folder.

    Batches are added in falling order of document ids. A run has one row per key:
    ``line``, ``docs`` and ``holder``. ``close`` removes all runs.
    """

    def __init__(self, spark: SparkSession, least_docs: int):
        self.spark = spark
        self.least_docs = least_docs
        self.levels: list[list[str]] = []
        self.database = f"line_runs_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{run_folder(spark)}'")

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def _write(self, keys: DataFrame) -> str:
        """One more run: a bucket for each shuffle partition, so that joins and merges
        of runs stay inside their buckets."""
        name = f"{self.database}.run_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        keys.write.bucketBy(buckets, "line").sortBy("line").saveAsTable(name)
        return name

    def merged(self, runs: list[str]) -> DataFrame:
        """The keys of several runs, each with all its documents.

        Two runs meet in a merge join of their buckets, without a shuffle.
        """

        def merge(one: DataFrame, other: DataFrame) -> DataFrame:
            names = {"docs": "other_docs", "holder": "other_holder"}
            both = one.join(other.withColumnsRenamed(names).hint("merge"), "line", "full_outer")
            docs = F.coalesce("docs", F.lit(0)) + F.coalesce("other_docs", F.lit(0))
            return both.select(
                "line", docs.alias("docs"), F.greatest("holder", "other_holder").alias("holder")
            )

        return reduce(merge, [self.spark.table(run) for run in runs])

    def add(self, entries: DataFrame) -> None:
        """Adds a batch of (line, id) rows; ids are below those of earlier batches."""
        once = entries.select("line", "id").distinct()
        keys = once.groupBy("line").agg(F.count("*").alias("docs"), F.max("id").alias("holder"))
        for run in self.runs():
            settled = self.spark.table(run).filter(F.col("docs") >= self.least_docs)
            keys = keys.join(settled.select("line").hint("merge"), "line", "left_anti")
        new, level = self._write(keys), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(new)
            if len(self.levels[level]) < 2:
                return
            full, self.levels[level] = self.levels[level], []
            new, level = self._write(self.merged(full)), level + 1
            for run in full:
                self.spark.sql(f"DROP TABLE {run}")

    def repeated(self) -> DataFrame:
        """Keys that enough documents hold, and the largest id that holds each."""
        found = self.merged(self.runs()).filter(F.col("docs") >= self.least_docs)
        return found.select("line", "holder")

    def close(self) -> None:
        self.spark.sql(f"DROP DATABASE {self.database} CASCADE")


def falling_batches(ids: DataFrame, batches: int) -> tuple[Column, int]:
    """Batch number of a column ``id``, 0 for the largest ids, and how many there are."""
    shares = [k / batches for k in range(1, batches)]
    cuts = ids.agg(F.percentile_approx("id", shares, 1000)).first()[0] if shares else None
    cuts = sorted(set(cuts or []))
    below = [F.when(F.col("id") < cut, 1).otherwise(0) for cut in cuts]
    number = reduce(lambda one, other: one + other, below, F.lit(0))
    return F.when(F.col("id").isNull(), len(cuts)).otherwise(number), len(cuts) + 1


def filtered(text: Column | str, gone: Column | str, least_chars: int) -> Column:
    """Struct of a text's number of lines, how many have a key in ``gone``, and the
    others joined again."""

    @F.arrow_udf("n_lines long, n_dropped long, kept string")
    def filter_udf(texts: pa.Array, drops: pa.Array) -> pa.Array:
        n_lines, n_dropped, kept = [], [], []
        for t, own in zip(texts.to_pylist(), drops.to_pylist(), strict=True):
            t = t or ""
            if own:
                lines, drop = t.encode().split(b"\n"), set(own)
                stay = [x for x in lines if line_hash(x, least_chars) not in drop]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay).decode())
            else:
                n_lines.append(t.count("\n") + 1)
                n_dropped.append(0)
                kept.append(t)
        return pa.StructArray.from_arrays(
            [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
            list(OUTPUTS),
        )

    return filter_udf(text, gone)


def drop_repeated(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_chars: int = 40,
    least_docs: int = 5,
    batches: int = 4,
) -> DataFrame:
    """Adds ``n_lines``, ``n_dropped`` and ``kept``, the text without repeated lines."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = run_folder(spark)
    keys = line_keys(docs, doc_id, text, least_chars)
    batch, count = falling_batches(docs.select(F.col(doc_id).cast("long").alias("id")), batches)
    keys.withColumn("batch", batch).write.partitionBy("batch").parquet(f"{folder}/entries")
    entries = spark.read.schema("line binary, id long, batch int").parquet(f"{folder}/entries")
    index = LineRuns(spark, least_docs)
    try:
        for k in range(count):
            index.add(entries.filter(F.col("batch") == k).select("line", "id"))
        index.repeated().write.parquet(f"{folder}/repeated")
    finally:
        index.close()
    repeated = spark.read.schema("line binary, holder long").parquet(f"{folder}/repeated")
    lost = entries.join(repeated, "line").filter(~F.col("id").eqNullSafe(F.col("holder")))
    gone = lost.groupBy("id").agg(F.collect_set("line").alias("gone"))
    # Positions for names, so that no column of the documents can clash.
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    same = F.col(at[doc_id]).cast("long").eqNullSafe(F.col("id"))
    joined = own.join(gone.hint("shuffle_hash"), same, "left")
    done = joined.withColumn("done", filtered(at[text], "gone", least_chars))
    kept = [F.col(at[c]).alias(c) for c in docs.columns if c not in OUTPUTS]
    return done.select(*kept, *[F.col(f"done.{c}") for c in OUTPUTS])
