"""Hard negatives of anchors by exact integer inner products.

Components are taken as whole numbers, floor(scale * x). Inner products come from
matrix products in float32 modulo several small primes (a residue number system): in
each, centred remainders are so small that a sum over ``CHUNK`` components stays below
2^24 and is exact. Chinese remaindering, digit by digit in mixed radix, gives back the
signed score. There are as many primes as the largest possible score needs, by the
largest sum of squares of any row.

Rows are dealt to blocks by a hash of their id. Each block's task holds its own rows as
residue matrices and streams all anchors past them, some at a time; so the rows move
once and an anchor once for each block. A first pass finds an anchor's positives, the
best rows of its own label, and multiplies rows of that label only. A second one finds
negatives: among rows of other labels, those whose score lies in the window of each
positive, from ``low`` to ``high`` hundredths of its score. A block gives a bounded
number for each anchor or window, and a ranked window over these gives the best of all.

Rows: those with a null id, label or vector, or with a null or non-finite component,
take no part. Of rows that repeat an id the one with the least label, then vector,
counts. Missing components of shorter vectors count as 0. Ties go to the smaller id. A
positive with a negative score has an empty window, one with score 0 the window 0. A table
whose scores may exceed 2^62 is refused. An empty table, or one without anchors, gives
no rows. Columns other than the three named are not read.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.store import stored

CHUNK = 128
# Components of a block's rows, and scores held at a time.
BLOCK_VALUES = 1 << 22
TILE_SCORES = 1 << 21
LARGEST = 1 << 62


def small_primes(over: int) -> list[int]:
    """Largest primes whose centred remainders stay exact, with a product above ``over``."""
    top = 2 * int(np.sqrt((1 << 24) / CHUNK)) - 1
    found, product = [], 1
    for p in range(top, 2, -1):
        if product > over:
            return found
        if all(p % q for q in range(2, int(p**0.5) + 1)):
            found.append(p)
            product *= p
    raise ValueError("the scores are too large")


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """Remainders modulo an odd ``p`` from -(p-1)/2 to (p-1)/2."""
    half = p // 2
    return (x + half) % p - half


class Residues:
    """Rows of whole numbers as float32 remainders, for exact products with others."""

    def __init__(self, rows: np.ndarray, primes: list[int]):
        self.primes = primes
        self.parts = [centred(rows, p).astype(np.float32) for p in primes]

    def scores(self, anchors: np.ndarray, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Inner products of the anchors with the rows from ``begin`` to ``end``."""
        digits: list[np.ndarray] = []
        total, weight = 0, 1
        for p, part in zip(self.primes, self.parts, strict=True):
            own = centred(anchors, p).astype(np.float32)
            product = 0
            for at in range(0, max(1, own.shape[1]), CHUNK):
                cut = slice(at, at + CHUNK)
                sums = own[:, cut] @ part[begin:end, cut].T
                product = product + sums.astype(np.int64)
            # What the digits so far leave, divided by the product of their primes.
            rest, base = product, 1
            for q, digit in zip(self.primes, digits, strict=False):
                rest = rest - digit * base
                base = base * q % p
            digit = centred(centred(rest, p) * pow(base, -1, p), p)
            digits.append(digit)
            total = total + digit * weight
            weight *= p
        return total


def best(scores: np.ndarray, most: int) -> np.ndarray:
    """Places of the highest scores, highest first, ties in order of place."""
    places = np.arange(len(scores))
    if len(scores) > most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        places = np.flatnonzero(scores >= least)
    return places[np.argsort(-scores[places], kind="stable")][:most]


def matrix(vectors: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of equal length from lists, filled with 0."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(len(vectors), dims)
    out = np.zeros((len(vectors), dims), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Stretches of equal block and kind (rows, then anchors) of sorted batches."""
    for batch in batches:
        key = 2 * batch["block"].to_numpy() + batch["anchor"].to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if begin < end:
                yield int(key[begin]) // 2, bool(key[begin] % 2), batch.slice(begin, end - begin)


class Block:
    """A block's rows, by label and id."""

    def __init__(self, pieces: list[pa.RecordBatch], dims: int, primes: list[int]):
        table = pa.Table.from_batches(pieces).combine_chunks()
        self.ids = table["id"].to_numpy()
        self.labels = table["label"].to_numpy()
        vectors = table["vector"].combine_chunks()
        self.residues = Residues(matrix(vectors, dims), primes)

    def of_label(self, label: int) -> tuple[int, int]:
        return tuple(np.searchsorted(self.labels, [label, label + 1]).tolist())


def block_job(
    visit: Callable[[Block, pa.RecordBatch, np.ndarray], list[tuple]],
    names: list[str],
    dims: int,
    primes: list[int],
) -> Callable:
    """A function over partitions that shows each block its anchors, some at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, block = None, [], None
        for number, is_anchor, piece in _pieces(batches):
            if number != current:
                current, rows, block = number, [], None
            if not is_anchor:
                rows.append(piece)
                continue
            if block is None:
                if not rows:
                    continue
                block, rows = Block(rows, dims, primes), [rows[0].slice(0, 0)]
            tile = max(1, TILE_SCORES // len(block.ids))
            for at in range(0, piece.num_rows, tile):
                part = piece.slice(at, tile)
                found = visit(block, part, matrix(part["vector"], dims))
                flat = np.array(found, np.int64).reshape(-1, len(names))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat[:, i]) for i in range(len(names))], names
                )

    return run


def find_positives(most: int) -> Callable:
    """Rows (anchor, id, score): a block's best rows of each anchor's label."""

    def visit(block: Block, part: pa.RecordBatch, vectors: np.ndarray) -> list[tuple]:
        ids, labels = part["id"].to_numpy(), part["label"].to_numpy()
        out = []
        for label in np.unique(labels).tolist():
            own = np.flatnonzero(labels == label)
            begin, end = block.of_label(label)
            if begin == end:
                continue
            scores = block.residues.scores(vectors[own], begin, end)
            for anchor, line in zip(ids[own].tolist(), scores, strict=True):
                other = np.flatnonzero(block.ids[begin:end] != anchor)
                at = other[best(line[other], most)]
                out += zip([anchor] * len(at), block.ids[begin + at], line[at], strict=True)
        return out

    return visit


def find_negatives(most: int, low: int, high: int) -> Callable:
    """Rows (anchor, positive, its score, id, score): a block's best rows of other labels
    in the window of each positive."""

    def visit(block: Block, part: pa.RecordBatch, vectors: np.ndarray) -> list[tuple]:
        scores = block.residues.scores(vectors)
        out = []
        columns = (part[c].to_pylist() for c in ("id", "label", "positives"))
        for anchor, label, positives, line in zip(*columns, scores, strict=True):
            # Of whole numbers: 100 * score from low * positive to high * positive.
            windows = [
                (p["id"], p["score"], -(-low * p["score"] // 100), high * p["score"] // 100)
                for p in positives
            ]
            windows = [w for w in windows if w[2] <= w[3]]
            if not windows:
                continue
            least, top = min(w[2] for w in windows), max(w[3] for w in windows)
            near = np.flatnonzero((line >= least) & (line <= top) & (block.labels != label))
            near = near[np.lexsort((block.ids[near], -line[near]))]
            falling = -line[near]
            for positive, score, bottom, ceiling in windows:
                begin = int(np.searchsorted(falling, -ceiling))
                end = int(np.searchsorted(falling, -bottom, "right"))
                at = near[begin : min(end, begin + most)]
                same = [(anchor, positive, score)] * len(at)
                out += [
                    (*key, i, s)
                    for key, i, s in zip(same, block.ids[at], line[at], strict=True)
                ]
        return out

    return visit


def whole_vectors(
    vectors: DataFrame, vec_id: str, label: Column | str, embedding: str, scale: int
) -> DataFrame:
    """``id``, ``label`` and ``vector`` of whole numbers of the rows that take part."""
    own = F.col(label) if isinstance(label, str) else label
    given = vectors.select(
        F.col(vec_id).cast("long").alias("id"),
        own.cast("long").alias("label"),
        F.transform(embedding, lambda x: F.lit(scale) * x.cast("double")).alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    whole = F.transform("vector", lambda x: F.floor(x))
    known = given.dropna().filter(finite).withColumn("vector", whole)
    least = F.min(F.struct("label", "vector")).alias("least")
    return known.groupBy("id").agg(least).select("id", "least.label", "least.vector")


def mine(
    vectors: DataFrame,
    anchors: Callable[[Column], Column],
    vec_id: str = "vec_id",
    label: Column | str = "label",
    embedding: str = "embedding",
    scale: int = 256,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Hard negatives of each anchor and positive, ranked from 1.

    ``anchors`` is a condition on the id. Columns: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.
    """
    spark = vectors.sparkSession
    rows = stored(whole_vectors(vectors, vec_id, label, embedding, scale))
    squares = F.reduce("vector", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    count, dims, largest = rows.agg(
        F.count("*"), F.max(F.size("vector")), F.max(squares)
    ).first()
    dims, largest = max(1, dims or 1), largest or 0.0
    if largest > LARGEST:
        raise ValueError("scores may exceed 2^62; use a smaller scale")
    # The sum of squares was rounded; a little more is safe.
    primes = small_primes(2 * int(largest * 1.001) + 1)
    at_most = max(1, BLOCK_VALUES // dims)
    wanted = -(-count // int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = max(1, -(-count // max(1, min(at_most, wanted))))
    number = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")

    def over_blocks(queries: DataFrame, visit: Callable, names: list[str]) -> DataFrame:
        """Results of showing the queries to every block."""
        extra = [c for c in queries.columns if c not in rows.columns]
        nothing = [F.lit(None).cast(queries.schema[c].dataType).alias(c) for c in extra]
        own = rows.select(number, F.lit(False).alias("anchor"), "*", *nothing)
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        shown = queries.select(every, F.lit(True).alias("anchor"), *own.columns[2:])
        dealt = own.unionByName(shown).repartitionById(blocks, F.col("block"))
        ordered = dealt.sortWithinPartitions("block", "anchor", "label", "id")
        schema = ", ".join(f"{name} long" for name in names)
        return ordered.mapInArrow(block_job(visit, names, dims, primes), schema)

    def ranked(found: DataFrame, by: list[str], most: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)

    queries = rows.filter(anchors(F.col("id")))
    found = over_blocks(queries, find_positives(n_positives), ["anchor_id", "id", "score"])
    own = ranked(found, ["anchor_id"], n_positives).groupBy("anchor_id").agg(
        F.collect_list(F.struct("id", "score")).alias("positives")
    )
    with_own = queries.join(own.withColumnRenamed("anchor_id", "id"), "id")
    names = ["anchor_id", "positive_id", "positive_score", "id", "score"]
    negatives = over_blocks(stored(with_own), find_negatives(n_negatives, low, high), names)
    return ranked(negatives, ["anchor_id", "positive_id"], n_negatives).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
