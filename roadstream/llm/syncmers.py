"""Document fingerprints of closed syncmers, in DataFrame functions only.

A text's units are its words, runs of more than 12 code points cut into such
pieces. A k-mer is ``K`` units in a row; its inner substrings are ``S`` units long.
A k-mer is an anchor (a closed syncmer) if the substring with the least hash stands
at either edge. That depends on the k-mer alone, not on its surroundings, so equal
passages have equal anchors, wherever they stand. A fingerprint lists the anchors
with their places; its likeness to another is the share of anchors that match at one
common shift of places.

Rows: a null text counts as empty. A text of fewer than ``K`` units has one anchor
for the whole sequence; one of ``K`` or more of which no k-mer is closed has the k-mer
with the least hash. Only a text without units has none; two such have likeness 1.
Very long texts are worked on whole, in time about linear in their units. Of shifts with
equally many matches it does not matter which. An empty table stays empty.
With null ids documents come first in order, those with equal ids by text. Other
columns stay; an output column replaces one of the same name.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S = 6, 2
UNIT = r"[^\x20\x09-\x0D]{1,12}"
HASH_BITS = 32


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also inside lambda functions."""
    return F.get(F.transform(F.array(value), body), 0)


def anchors(text: Column | str, k: int = K, s: int = S) -> Column:
    """Anchors of a text in order: array of struct (pos int, hash long)."""
    column = F.col(text) if isinstance(text, str) else text
    units = F.regexp_extract_all(F.coalesce(column, F.lit("")), F.lit(UNIT), F.lit(0))
    mask = F.lit((1 << HASH_BITS) - 1)

    def anchor(pos: Column, code: Column) -> Column:
        return F.struct(pos.cast("int").alias("pos"), code.bitwiseAND(mask).alias("hash"))

    def inner(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(h) - s)
        return F.transform(places, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(s)]))

    def closed(g: Column) -> Column:
        last = k - s

        def at_edge(i: Column) -> Column:
            least = F.least(*[F.get(g, i + j) for j in range(last + 1)])
            return (F.get(g, i) == least) | (F.get(g, i + last) == least)

        starts = F.sequence(F.lit(0), F.size(g) - last - 1)
        parts = [*range(0, last, s), last]

        def code(i: Column) -> Column:
            return F.xxhash64(*[F.get(g, i + j) for j in parts])

        def or_least(kept: Column) -> Column:
            every = F.transform(starts, lambda i: F.struct(code(i).alias("code"), i.alias("i")))
            return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.array_min(every)["i"]))

        kept = bound(F.filter(starts, at_edge), or_least)
        return F.transform(kept, lambda i: anchor(i, code(i)))

    def of_hashes(h: Column) -> Column:
        none = F.filter(F.array(anchor(F.lit(0), F.lit(0).cast("long"))), lambda x: F.lit(False))
        whole = F.array(anchor(F.lit(0), F.xxhash64(h)))
        return (
            F.when(F.size(h) >= k, bound(inner(h), closed))
            .when(F.size(h) > 0, whole)
            .otherwise(none)
        )

    return bound(F.transform(units, lambda u: F.xxhash64(u)), of_hashes)


def as_text(found: Column | str) -> Column:
    """Anchors as text: ``place:hash`` of each, separated by spaces."""
    column = F.col(found) if isinstance(found, str) else found
    written = F.transform(
        column, lambda a: F.concat_ws(":", a["pos"].cast("string"), F.lower(F.hex(a["hash"])))
    )
    return F.array_join(written, " ")


def likeness(a: Column | str, b: Column | str, candidates: int = 8) -> Column:
    """Anchors that agree in hash and in one common shift of places, as a share of the mean
    number of anchors of two texts.

    The shift is the best of 0 and those of the common anchors with the least hashes, up
    to ``candidates``; an anchor's place is its first. So a passage counts wherever it
    stands, but passages in another order, or twice, do not all count.
    """
    left, right = (F.col(x) if isinstance(x, str) else x for x in (a, b))

    def placed(found: Column, shift: Column) -> Column:
        """Place and hash of each anchor as one number."""
        return F.transform(
            found, lambda x: (x["pos"] + shift).cast("long") * (1 << HASH_BITS) + x["hash"]
        )

    def place(found: Column, code: Column) -> Column:
        at = F.array_position(found["hash"], code).cast("int") - 1
        return F.get(found["pos"], at).cast("long")

    def best(common: Column) -> Column:
        few = F.slice(F.array_sort(common), 1, candidates)
        moves = F.transform(few, lambda h: place(right, h) - place(left, h))
        shifts = F.array_distinct(F.array_append(moves, F.lit(0).cast("long")))

        def matches(other: Column) -> Column:
            return F.array_max(
                F.transform(shifts, lambda s: F.size(F.array_intersect(placed(left, s), other)))
            )

        return F.when(F.size(common) > 0, bound(placed(right, F.lit(0)), matches)).otherwise(0)

    total = F.size(left) + F.size(right)
    same = bound(F.array_intersect(left["hash"], right["hash"]), best)
    return F.when(total > 0, 2.0 * same / total).otherwise(1.0)


def fingerprint(df: DataFrame, text: str = "text", output: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of ``text``."""
    return df.withColumn(output, as_text(anchors(text)))


def positional_matches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Passages that documents share: anchors in common at one distance of places.

    Both sides have ``doc_id`` and ``anchors``. Gives ``doc_id``, ``other_id``,
    ``shift`` (place in the other less place here), ``first``, ``last`` and ``n``.
    Pairs meet on their anchors' hashes; use it on chosen pairs of documents or on
    texts without anchors that very many share.
    """
    own = left.select("doc_id", F.inline("anchors"))
    other = right.select(
        F.col("doc_id").alias("other_id"), F.explode("anchors").alias("_o")
    ).select("other_id", F.col("_o.pos").alias("_pos"), F.col("_o.hash").alias("hash"))
    met = own.join(other, "hash").filter("doc_id <> other_id")
    return met.groupBy("doc_id", "other_id", (F.col("_pos") - F.col("pos")).alias("shift")).agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.count("*").alias("n")
    )


def number_below(value: Column, cuts: list[int]) -> Column:
    """How many of the ascending ``cuts`` are less than ``value``.

    Looks through the first cut of each piece, then through one piece.
    """
    piece = max(1, int(len(cuts) ** 0.5))
    pieces = [cuts[i : i + piece] for i in range(0, len(cuts), piece)]
    if not pieces:
        return F.lit(0)

    def longs(own: list[int]) -> Column:
        return F.array(*[F.lit(c).cast("long") for c in own]).cast("array<long>")

    table = F.array(*[longs(own) for own in pieces])
    return bound(
        F.size(F.filter(longs([own[0] for own in pieces[1:]]), lambda c: c < value)),
        lambda i: i * piece + F.size(F.filter(F.get(table, i), lambda c: c < value)),
    )


def with_next(docs: DataFrame) -> DataFrame:
    """Adds ``anchors`` and, from the next document by id (after the last: the first),
    ``next_text`` and ``next_anchors``.

    Ids are cut into ranges by approximate percentiles, four times as many as shuffle
    partitions; the text moves once. A range's last document finds its next in a table
    of the first document of each range.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long"))
    ordered = docs.withColumn("_rank", rank)
    shares = [i / ranges for i in range(1, ranges)]
    cuts = ordered.agg(F.percentile_approx("_rank", shares, 50 * ranges)).first()[0] or []
    ranged = ordered.withColumn("_range", number_below(F.col("_rank"), sorted(set(cuts))))

    least = ranged.groupBy("_range").agg(F.min("_rank").alias("_rank"))
    every = Window.partitionBy(F.lit(0)).orderBy("_range")
    order = least.select(
        "_range",
        F.coalesce(
            F.lag("_range").over(every), F.max("_range").over(Window.partitionBy(F.lit(0)))
        ).alias("_before"),
    )
    # At most one row for each range, so both joins are with bounded tables.
    first = (
        ranged.select("_range", "_rank", "text")
        .join(F.broadcast(least), ["_range", "_rank"])
        .groupBy("_range")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("_first"))
        .join(F.broadcast(order), "_range")
        .select(
            F.col("_before").alias("_range"), "_first", anchors("_first").alias("_first_anchors")
        )
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    in_range = Window.partitionBy("_range").orderBy("_rank", "text")
    return (
        ranged.withColumn("text", text)
        .repartition("_range")
        .withColumn("anchors", anchors("text"))
        .withColumns(
            {
                "next_text": F.lead("text").over(in_range),
                "next_anchors": F.lead("anchors").over(in_range),
            }
        )
        .join(first, "_range", "left")
        .withColumns(
            {
                "next_anchors": F.when(F.col("next_text").isNull(), F.col("_first_anchors"))
                .otherwise(F.col("next_anchors")),
                "next_text": F.coalesce("next_text", "_first"),
            }
        )
        .drop("_range", "_rank", "_first", "_first_anchors")
    )


def with_edit(docs: DataFrame) -> DataFrame:
    """``docs`` of ``with_next`` and ``edited``: the last quarter of the text's code
    points replaced by the first as many of the next text; and ``edited_anchors``."""
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - cut),
        F.substring(F.col("next_text"), F.lit(1), cut),
    )
    return docs.withColumn("edited", edited).withColumn("edited_anchors", anchors("edited"))
