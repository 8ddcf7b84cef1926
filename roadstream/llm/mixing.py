"""Mixing sources to target weights by hash-threshold histograms.

Each document has a place in [0, 2^60) from a hash of its id. A source takes all
its documents as often as the target allows whole, and the rest of the target
from the documents with the least places. The threshold comes from histograms
of sizes by source and place: the bucket in which the budget ends is cut into
1024 finer ones, again and again, until one place is left. Nothing is sorted, and
only the documents of the last bucket are looked at again.

Rows: a null text has size 0; the null source is a source of its own, the last.
Rows with equal ids (null counts as an empty id) share a place and are taken
together. Documents without words are taken as often as their places say, at most
``MOST`` times; a source without words has target 0 and is not taken. Very long texts are
taken whole. An empty table gives no rows. Other columns stay, whatever their names; an
output column replaces one of the same name.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.store import shielded, stored, unshielded
from roadstream.llm.words import WORD
from roadstream.operators.sizes import dimension_join

WEIGHTS = (5, 2, 1)  # by code point order of the sources, repeating
SHARE = 1.5  # of all sizes
MOST = 2  # times a source's size
PLACE_BITS, STEP_BITS = 60, 10


def size_of(text: Column | str) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def place_of(doc_id: Column | str) -> Column:
    """The first 60 bits of the md5 of the id as text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, ``_place`` and a source key without nulls."""
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    return docs.withColumns(
        {"_key": key, "size": size_of("text"), "_place": place_of("doc_id")}
    )


def targets(rows: DataFrame) -> DataFrame:
    """Size and target of each source: one row per source, so few rows.

    The targets are ``min(weight * level, cap)`` with one level for all sources:
    sorted by cap per weight, the level is what is left for the sources from the
    first on that stays below its cap.
    """
    per_source = rows.groupBy("_key").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy((F.col("_key") == ""), "_key")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in WEIGHTS]),
        ((F.row_number().over(in_order) - 1) % len(WEIGHTS) + 1).cast("int"),
    )
    cap = (MOST * F.col("source_size")).cast("double")
    by_cap = Window.orderBy("_ratio", "_key")
    ahead = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    left = F.lit(SHARE) * F.sum("source_size").over(everything) - F.coalesce(
        F.sum("_cap").over(ahead), F.lit(0.0)
    )
    weights = F.sum("_weight").over(everything) - F.coalesce(
        F.sum("_weight").over(ahead), F.lit(0.0)
    )
    level = left / weights
    return (
        per_source.withColumns({"_weight": weight, "_cap": cap})
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_level", level)
        .withColumn(
            "_level",
            F.min_by(
                "_level",
                F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_key")),
            ).over(everything),
        )
        .select(
            "_key",
            "source_size",
            F.coalesce(
                F.least(F.col("_weight") * F.col("_level"), "_cap"), F.col("_cap"), F.lit(0.0)
            ).alias("target"),
        )
    )


def thresholds(rows: DataFrame, source_targets: DataFrame) -> DataFrame:
    """Adds to each source ``times``, its whole takes, and ``_limit``: documents with
    places below it are taken once more."""
    times = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    level = stored(
        source_targets.withColumn("times", times.cast("long"))
        .withColumn("_budget", F.col("target") - F.col("times") * F.col("source_size"))
        .withColumn("_prefix", F.lit(0).cast("long"))
    )
    few = Window.partitionBy("_key").orderBy("_bucket")
    for shift in range(PLACE_BITS - STEP_BITS, -1, -STEP_BITS):
        own = level.select("_key", "_prefix")
        ends = (
            dimension_join(rows.select("_key", "_place", "size"), own, "_key")
            .filter(F.shiftright("_place", shift + STEP_BITS) == F.col("_prefix"))
            .groupBy("_key", F.shiftright("_place", shift).alias("_bucket"))
            .agg(F.sum("size").alias("_sum"))
            .withColumn("_upto", F.sum("_sum").over(few))
            # The bucket in which the budget ends, at most 1024 to choose from.
            .join(level.select("_key", "_budget"), "_key")
            .filter(F.col("_upto") > F.col("_budget"))
            .groupBy("_key")
            .agg(
                F.min("_bucket").alias("_bucket"),
                F.min_by("_upto", "_bucket").alias("_upto"),
                F.min_by("_sum", "_bucket").alias("_sum"),
            )
        )
        next_level = level.join(ends, "_key", "left")
        # Without such a bucket all of the last one fits: its upper end is the limit.
        beyond = F.shiftleft(F.col("_prefix") + 1, STEP_BITS)
        level = stored(
            next_level.select(
                "_key",
                "source_size",
                "target",
                "times",
                (F.col("_budget") - F.coalesce(F.col("_upto") - F.col("_sum"), F.lit(0))).alias(
                    "_budget"
                ),
                F.coalesce("_bucket", beyond).alias("_prefix"),
                F.col("_sum").alias("_last"),
            )
        )
    # The last bucket is one place; its rows are taken if that comes nearer. A source that
    # whole takes satisfy has no more, also not of its documents without words.
    closer = F.coalesce(2 * F.col("_budget") >= F.col("_last"), F.lit(False))
    over = F.col("target") > F.col("times") * F.col("source_size")
    limit = F.when(over, F.col("_prefix") + closer.cast("long")).otherwise(F.lit(0))
    return level.select("_key", "source_size", "target", "times", limit.alias("_limit"))


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``times`` (how often the mix
    takes the document, at most ``MOST``) and ``taken`` words."""
    plain, names = shielded(docs, ["doc_id", "text", "source"])
    rows = stored(sized(plain).select("_key", "_place", "size"))
    plan = stored(thresholds(rows, targets(rows)))
    chosen = plan.select("_key", "source_size", "target", F.col("times").alias("_t"), "_limit")
    times = F.col("_t") + (F.col("_place") < F.col("_limit")).cast("long")
    mixed = (
        dimension_join(sized(plain), chosen, "_key")
        .withColumn("times", times)
        .withColumn("taken", F.col("size") * F.col("times"))
    )
    return unshielded(mixed, names, ["size", "source_size", "target", "times", "taken"])


def repeated(mixed: DataFrame) -> DataFrame:
    """The documents of a mix as often as it takes them."""
    plain, names = shielded(mixed.filter(F.col("times") > 0), ["times"])
    copies = plain.withColumn("copy", F.explode(F.sequence(F.lit(1), "times")))
    return unshielded(copies, names)
