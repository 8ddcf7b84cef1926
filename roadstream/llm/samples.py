"""Bounded samples of labelled documents to fit classifiers on."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids count as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def class_labels(labels: DataFrame, label: str) -> DataFrame:
    """One 0/1 label per id; rows without either are left out, 1 wins over 0."""
    given = labels.select("doc_id", F.col(label).cast("int").alias("_label"))
    usable = given.filter(F.col("doc_id").isNotNull() & F.col("_label").isin(0, 1))
    return usable.groupBy("doc_id").agg(F.max("_label").alias("_label"))


def class_counts(known: DataFrame) -> tuple[int, int]:
    """Labelled ids of class 0 and of class 1."""
    row = known.agg(F.count_if(F.col("_label") == 0), F.count_if(F.col("_label") == 1)).first()
    return row[0], row[1]


def labelled_sample(docs: DataFrame, known: DataFrame, rows_per_class: int) -> DataFrame:
    """``doc_id``, ``_label`` and text of at most ``rows_per_class`` labelled ids of each class.

    Takes the ids with the least hashes, and of rows that repeat an id the least text,
    so that reruns agree. The ids are broadcast: there are at most twice
    ``rows_per_class``, and as many rows leave.
    """
    order = [F.xxhash64(F.col("doc_id"), F.lit(7)), F.col("doc_id")]
    own = [
        known.filter(F.col("_label") == value).orderBy(*order).limit(rows_per_class)
        for value in (0, 1)
    ]
    ids = own[0].unionByName(own[1])
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    once = rows.groupBy("doc_id").agg(F.max("_label").alias("_label"), F.min("text").alias("text"))
    return once.sortWithinPartitions("doc_id")
