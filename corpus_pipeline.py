"""Documents made ready for training in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its
result is written as Parquet and read again. Toxic documents go, then those of low
quality, then all but one of each group of near duplicates; the sources are mixed to
their target weights, some documents twice, others not at all; the rest is encoded.
The classifiers learn from the labelled rows of ``sf_dir`` that are among ``docs`` and
not held out.

Rows: a null text counts as empty and stays null; it is scored, mixed with size 0 and
encoded to no tokens. Very long texts go through whole. Rows with null ids are no
duplicates of anything; rows with equal ids and texts are one document from the third
stage on. A score equal to the threshold counts as above it. Other columns come through
unchanged, whatever their names and types, and only ``n_tokens``, ``token_ids`` and
``decodes`` of the last stage replace columns of the same name. An empty table passes
through all stages.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.llm import bpe, jaccard, mixing, quality, samples, toxicity
from roadstream.llm.queries import VOCABULARY
from roadstream.llm.store import shielded, unshielded
from roadstream.operators.sizes import run_folder

THRESHOLD = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, samples.id_remainder("doc_id", 4) != 2)
    return docs.filter(toxicity.score("text", model, docs) < THRESHOLD)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, samples.id_remainder("doc_id", 5) != 0)
    return docs.filter(quality.score("text", model, docs) >= THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain, names = shielded(docs, ["doc_id", "text", "source"])
    return unshielded(mixing.repeated(mixing.mix(plain)), names)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and whether these decode to the text."""
    plain, names = shielded(docs, ["text"])
    coded = bpe.round_trip(plain, VOCABULARY, ids="token_ids", back="back", packed=False)
    done = coded.withColumns(
        {
            "n_tokens": F.size("token_ids").cast("long"),
            "decodes": F.col("back") == F.coalesce("text", F.lit("")),
        }
    )
    return unshielded(done, names, ["n_tokens", "token_ids", "decodes"])


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# The classifiers and the sketch join have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
