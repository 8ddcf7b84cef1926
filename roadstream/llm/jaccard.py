"""Jaccard join of word shingle sets by parity sketches.

Two sets with a similarity of 0.75 or more differ in at most a third of either's
size. The method, exact up to collisions of 64-bit hashes:

* Equal sets form one class, a node of the graph; only its key is handled on.
* A node's shingles are dealt by hash into the blocks of a size band. A block's key
  is the XOR of its shingles' hashes, so one differing shingle changes one key: the
  number of differing blocks is a lower bound of the symmetric difference D, and
  of B blocks at least B - D agree. By the pigeonhole principle two nodes then share
  one of the D + 1 keys that come first in any order common to all. The order puts
  blocks with shingles that are rare in a bounded sample first; it decides only how
  many pairs meet by chance.
* Bands are sizes up to 4, 16, 64 ...; a node joins its own band and, if a partner
  may be larger than that band's end, the next one.
* In each group of nodes with a common key, the least node is paired with the others.
  Pairs pass if their parity bit sketches (a bit is flipped by each shingle that
  hashes to it, so their Hamming distance is a lower bound of D too) allow the
  similarity; then the sets themselves are compared.
* Groups whose other nodes are not within one component yet are left. Pivots of each,
  from the smallest components on, are held against the others of the group by size
  and sketch, a block of the group at a time, and what passes is compared, until every
  pair that shares a key is compared or within one component. A pair is passed on from
  one of the groups it shares, not from all.

Rows: a null or empty text, or one without words, has size 0 and is its own
component. With a null id a row takes no part; its component is null. Rows with
equal ids are told apart by their sets. Other columns are ignored.
"""

from collections.abc import Iterator
from itertools import batched, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadstream.llm import words
from roadstream.llm.components import components
from roadstream.llm.store import shielded, small_batches, stored, unshielded

K = 5
SLICE = 64
SAMPLE_ROWS = 4000  # documents looked at to tell common shingles; affects speed only
COMMON = 4  # of them that hold a common shingle
PIVOTS = 256  # of a group in the second round; 16 times as many in each later one
BLOCK = 1024  # nodes of a group that a step holds, beside as many pivots
CELL = 100_000  # nodes of a group that are ranked together
LISTED_KEYS = 64  # of a node, to tell in which of the shared groups a pair counts
BLOOM_BITS = 1 << 26  # at most

EMPTY = np.uint64(0x5BF03635F0935AD1)


def set_key(shingles: np.ndarray) -> np.uint64:
    """Hash of a set."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(words.mixed(shingles ^ EMPTY)) + np.uint64(len(shingles))
        return words.mixed(np.array([total], np.uint64))[0]


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """Bit sketch: 64-bit words, a power of two of them, at least two bits a shingle."""
    bits = max(64, 1 << int(2 * len(shingles) - 1).bit_length()) if len(shingles) else 64
    at = (words.mixed(shingles + words.MIX_1) & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(at, minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).view("<i8")


def least_difference(a: np.ndarray, b: np.ndarray) -> int:
    """Lower bound of the symmetric difference from two bit sketches."""
    a, b = a.view(np.uint8), b.view(np.uint8)
    while len(a) > len(b):  # bit i and bit i + half become one
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.unpackbits(a ^ b).sum())


def bands(size: int) -> list[int]:
    """Upper ends of the size bands in which a set takes part."""
    end = 4
    while size > end:
        end *= 4
    return [end] if size * 4 // 3 <= end else [end, end * 4]


def block_keys(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The keys under which a set meets its partners."""
    size = len(shingles)
    if size < 3:  # partners of such sets are equal to them
        return np.zeros(0, np.uint64)
    take, out = size // 3 + 1, []
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        rare = (common[at] != shingles).astype(np.int64)
    else:
        rare = np.ones(size, np.int64)
    with np.errstate(over="ignore"):
        for end in bands(size):
            blocks = end if end <= 64 else end // 2
            salt = words.mixed(np.array([end], np.uint64))
            spread = words.mixed(shingles ^ salt)
            block = (spread >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
            order = np.argsort(block, kind="stable")
            own = block[order]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            joined = np.bitwise_xor.reduceat(words.mixed(spread[order] + words.GOLDEN), first)
            full = own[first]
            key = words.mixed(joined ^ words.mixed(full + salt))
            rank = 2 - np.minimum(np.add.reduceat(rare[order], first), 2)
            if len(full) < take:  # empty blocks come after all others in everyone's order
                free = np.setdiff1d(np.arange(blocks, dtype=np.uint64), full)
                key = np.concatenate([key, words.mixed(EMPTY ^ words.mixed(free + salt))])
                rank = np.concatenate([rank, np.full(len(free), 3)])
            place = (rank.astype(np.uint64) << np.uint64(62)) | (key >> np.uint64(2))
            if len(key) > take:
                key = key[np.argpartition(place, take - 1)[:take]]
            out.append(key)
    return np.concatenate(out)


def _slices(batches: Iterator[pa.RecordBatch], k: int):
    """Ids and shingle sets of the texts, some documents at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            part = batch.slice(i, SLICE)
            texts = part.column("text").to_pylist()
            yield part, words.shingle_sets(texts, k)


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def shingle_nodes(docs: DataFrame, k: int = K) -> DataFrame:
    """``doc_id``, ``size`` of the shingle set, its ``node`` and its bit ``sketch``."""

    def rows(batches):
        for part, sets in _slices(batches, k):
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _long([set_key(s) for s in sets]),
                    pa.array([parity_bits(s).tobytes() for s in sets], pa.binary()),
                ],
                ["doc_id", "size", "node", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        rows, "doc_id long, size long, node long, sketch binary"
    )


def common_shingles(docs: DataFrame, k: int = K) -> np.ndarray:
    """Shingles that several documents of a bounded sample hold, ascending.

    The sample takes different sets with hashes of ids below a threshold. At most
    ``SAMPLE_ROWS`` times the mean set size / ``COMMON`` shingles come to the driver.
    """
    total = docs.count()
    limit = int(min(1.0, SAMPLE_ROWS / max(1, total)) * 2**31)
    chance = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(2**31))

    def rows(batches):
        for _, sets in _slices(batches, k):
            lists = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            nodes = _long([set_key(s) for s in sets])
            yield pa.RecordBatch.from_arrays([nodes, lists], ["node", "shingles"])

    sample = docs.filter(chance < limit).select("doc_id", "text")
    found = (
        sample.mapInArrow(rows, "node long, shingles array<long>")
        .dropDuplicates(["node"])
        .select(F.explode("shingles").alias("s"))
        .groupBy("s")
        .count()
        .filter(F.col("count") >= COMMON)
        .select("s")
        .toPandas()
    )
    return np.sort(found["s"].to_numpy(np.int64).view(np.uint64))


def node_keys(docs: DataFrame, k: int = K) -> DataFrame:
    """``key`` and ``node`` of every block key; a task gives a node's keys once."""
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, k))

    def rows(batches):
        common, seen = shared.value, set()
        for _, sets in _slices(batches, k):
            keys, nodes = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for s in sets:
                if len(s) >= 3 and (node := int(set_key(s))) not in seen:
                    seen.add(node)
                    keys.append(block_keys(s, common))
                    nodes.append(np.full(len(keys[-1]), node, np.uint64))
            both = [_long(np.concatenate(keys)), _long(np.concatenate(nodes))]
            yield pa.RecordBatch.from_arrays(both, ["key", "node"])

    return docs.select("doc_id", "text").mapInArrow(rows, "key long, node long")


def _similar(percent: int, a: int, b: int, difference: int) -> bool:
    """Whether sets of these sizes with at least this difference may be similar."""
    both = (a + b - difference) / 2  # at most this many in common
    return 100 * both >= percent * (a + b - both)


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and bit sketches allow the similarity."""

    @F.arrow_udf("boolean")
    def may_match(na: pa.Array, sa: pa.Array, nb: pa.Array, sb: pa.Array) -> pa.Array:
        rows = zip(*(x.to_pylist() for x in (na, sa, nb, sb)), strict=True)
        return pa.array(
            [
                _similar(percent, x, y, least_difference(np.frombuffer(s, "<i8"), np.frombuffer(t, "<i8")))
                for x, s, y, t in rows
            ],
            pa.bool_(),
        )

    def side(name):
        return nodes.select(
            F.col("node").alias(name),
            F.col("size").alias(f"_n{name}"),
            F.col("sketch").alias(f"_s{name}"),
        )

    sizes = (100 * F.least("_na", "_nb") >= percent * F.greatest("_na", "_nb"))
    met = pairs.join(side("a"), "a").join(side("b"), "b").filter(sizes)
    return met.filter(may_match("_na", "_sa", "_nb", "_sb")).select("a", "b")


def _bloom_positions(h: np.ndarray, bits: int) -> np.ndarray:
    """Four positions of each 64-bit hash, one column each."""
    h = h.view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(4)])


def bloom_filter(ids: DataFrame) -> np.ndarray:
    """Bloom filter (bytes) of the long column ``doc_id``; its size has a fixed bound.

    Built in segments of 4 KB, so that each task holds the ids of some segments.
    """
    hashed = stored(ids.select(F.xxhash64("doc_id").alias("h")))
    bits = min(BLOOM_BITS, max(1 << 15, 1 << int(16 * hashed.count()).bit_length()))

    def positions(batches):
        for batch in batches:
            at = np.unique(_bloom_positions(batch.column("h").to_numpy(), bits))
            yield pa.RecordBatch.from_arrays([_long(at)], ["at"])

    def segment(table: pa.Table) -> pa.Table:
        at = table.column("at").to_numpy()
        odd = np.zeros(1 << 15, np.uint8)
        odd[at & ((1 << 15) - 1)] = 1
        return pa.table(
            {"segment": [int(at[0]) >> 15], "bits": [np.packbits(odd).tobytes()]},
            schema=pa.schema([("segment", pa.int64()), ("bits", pa.binary())]),
        )

    parts = (
        hashed.mapInArrow(positions, "at long")
        .distinct()
        .groupBy(F.shiftright("at", 15).alias("segment"))
        .applyInArrow(segment, "segment long, bits binary")
        .toPandas()
    )
    out = np.zeros(bits >> 3, np.uint8)
    for number, own in zip(parts["segment"], parts["bits"], strict=True):
        out[number << 12 : (number + 1) << 12] = np.frombuffer(own, np.uint8)
    return out


def shingle_rows(docs: DataFrame, wanted: DataFrame, k: int = K) -> DataFrame:
    """``node`` and its packed ``shingles`` for the nodes of ``wanted`` (node, doc_id).

    The texts of other documents are passed over by a Bloom filter of the ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bloom_filter(wanted))

    def rows(batches):
        bloom = shared.value
        for batch in batches:
            at = _bloom_positions(batch.column("h").to_numpy(), len(bloom) * 8)
            inside = ((bloom[at >> np.uint64(3)] << (at & np.uint64(7)).astype(np.uint8)) & 128) > 0
            kept = batch.filter(pa.array(inside.all(axis=0)))
            for _, sets in _slices([kept], k):
                yield pa.RecordBatch.from_arrays(
                    [_long([set_key(s) for s in sets]), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["node", "shingles"],
                )

    hashed = docs.select(F.xxhash64(F.col("doc_id").cast("long")).alias("h"), "text")
    found = hashed.mapInArrow(rows, "node long, shingles binary")
    return found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity."""

    @F.arrow_udf("boolean")
    def match(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(left, right, strict=True):
            x = np.frombuffer(a.as_py(), np.uint64)
            y = np.frombuffer(b.as_py(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pa.array(out, pa.bool_())

    def side(name):
        return sets.select(F.col("node").alias(name), F.col("shingles").alias(f"_s{name}"))

    met = pairs.join(side("a"), "a").join(side("b"), "b")
    return met.filter(match("_sa", "_sb")).select("a", "b")


def _checked_links(docs, near, nodes, percent, k) -> DataFrame:
    """The links among the pairs ``near``, from the sets themselves."""
    ends = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    wanted = stored(nodes.join(ends, "node", "left_semi").select("node", "doc_id"))
    sets = stored(shingle_rows(docs, wanted, k))
    return stored(linked(near, sets, percent))


def _unsettled(left: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (key, node, label, rank, n) of the groups with several components.

    ``rank`` counts from the group's smallest component on; ``n`` is the group's size.
    Groups and components are counted before they are shuffled, and the ranks of a group
    come from windows over cells of about ``CELL`` of its nodes, so a large one is spread.
    """
    labelled = left.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    groups = (
        labelled.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("label").alias("_low"), F.max("label").alias("_high"))
        .filter("_low <> _high")
        .select("key", "n")
    )
    several = stored(labelled.join(groups, "key"))
    sizes = several.groupBy("key", "label").agg(F.count("*").alias("_size"))
    cell = F.pmod(F.xxhash64("node"), 1 + F.floor(F.col("n") / CELL))
    dealt = stored(several.join(sizes, ["key", "label"]).withColumn("_cell", cell))
    cells = dealt.groupBy("key", "_size", "_cell").agg(F.count("*").alias("_in_cell"))
    by_size = Window.partitionBy("key").orderBy("_size", "_cell")
    earlier = F.sum("_in_cell").over(by_size.rowsBetween(Window.unboundedPreceding, -1))
    before = cells.withColumn("_before", F.coalesce(earlier, F.lit(0))).drop("_in_cell")
    in_cell = Window.partitionBy("key", "_size", "_cell").orderBy("label", "node")
    return (
        dealt.withColumn("_place", F.row_number().over(in_cell))
        .join(before, ["key", "_size", "_cell"])
        .withColumn("rank", F.col("_before") + F.col("_place"))
        .select("key", "node", "label", "rank", "n")
    )


def _folded(sketches: list[bytes], length: int) -> np.ndarray:
    """Sketches of one length as rows of 64-bit words, folded to ``length`` bytes."""
    rows = np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)
    while rows.shape[1] * 8 > length:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


def _run_pairs(rows: Iterator[tuple], percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of a pivot and a member of one block that may be similar.

    ``rows``: (key, block, pivot, node, label, rank, size, sketch, keys), members first.
    However many pivots follow, at most ``BLOCK`` of them are held.
    """
    members, pivots = [], []
    for row in rows:
        (pivots if row[2] else members).append(row)
        if len(pivots) == BLOCK:
            yield from _met(members + pivots, percent)
            pivots = []
    if pivots:
        yield from _met(members + pivots, percent)


def _met(rows: list[tuple], percent: int) -> Iterator[tuple[int, int]]:
    """The pairs of ``_run_pairs`` among some rows."""
    sides = []
    for is_pivot in (True, False):
        by_length: dict[int, list[tuple]] = {}
        for row in rows:
            if row[2] == is_pivot:
                by_length.setdefault(len(row[7]), []).append(row)
        sides.append(by_length)
    for length, pivots in sides[0].items():
        for other, members in sides[1].items():
            short = min(length, other)
            left = _folded([r[7] for r in pivots], short)
            right = _folded([r[7] for r in members], short)
            label, rank, size = (np.array([r[i] for r in members]) for i in (4, 5, 6))
            for pivot, sketch in zip(pivots, left, strict=True):
                both = pivot[6] + size
                most = (both - np.bitwise_count(right ^ sketch).sum(axis=1, dtype=np.int64)) / 2
                fits = (label != pivot[4]) & (rank > pivot[5])
                fits &= 100 * np.minimum(size, pivot[6]) >= percent * np.maximum(size, pivot[6])
                fits &= 100 * most >= percent * (both - most)
                for i in np.flatnonzero(fits):
                    shared = set(pivot[8]).intersection(members[i][8])
                    if not shared or min(shared) == pivot[0]:
                        yield min(pivot[3], members[i][3]), max(pivot[3], members[i][3])


def _group_pairs(left: DataFrame, nodes: DataFrame, percent: int, pivots: int) -> DataFrame:
    """Pairs (a, b) of pivots and other nodes of their groups that may be similar."""
    listed = left.groupBy("node").agg(
        F.slice(F.sort_array(F.collect_list("key")), 1, LISTED_KEYS).alias("keys")
    )
    known = listed.join(nodes.select("node", "size", "sketch"), "node")
    rows = left.join(known, "node")
    place = F.floor((F.col("rank") - 1) / BLOCK)
    last = F.floor((F.col("n") - 1) / BLOCK)
    columns = ["key", "block", "pivot", "node", "label", "rank", "size", "sketch", "keys"]
    members = rows.withColumns({"block": place, "pivot": F.lit(False)}).select(columns)
    copies = (
        rows.filter(F.col("rank") <= pivots)
        .withColumns({"block": F.explode(F.sequence(F.lit(0), last)), "pivot": F.lit(True)})
        .select(columns)
    )

    def pairs(batches):
        flat = (
            row
            for batch in batches
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)
        )
        for _, run in groupby(flat, key=lambda row: row[:2]):
            for found in batched(_run_pairs(run, percent), 10_000):
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    dealt = members.union(copies).repartition("key", "block")
    in_runs = dealt.sortWithinPartitions("key", "block", "pivot", "rank")
    return in_runs.mapInArrow(pairs, "a long, b long").distinct()


def similar_nodes(docs: DataFrame, nodes: DataFrame, k: int = K, percent: int = 75) -> DataFrame:
    """``node`` and ``label`` of all nodes with a link; see the module's text.

    ``nodes`` has one row per class: node, doc_id (one of the class), size, sketch.
    """
    by_key = Window.partitionBy("key")
    shared = stored(
        node_keys(docs, k)
        .withColumns({"pivot": F.min("node").over(by_key), "_last": F.max("node").over(by_key)})
        .filter("pivot <> _last")
        .select("key", "node", "pivot")
        .dropDuplicates(["key", "node"])
    )
    others = shared.filter("node <> pivot")
    pairs = stored(others.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct())
    near = stored(likely(pairs, nodes, percent))
    links, checked = _checked_links(docs, near, nodes, percent, k), near
    left, pivots = others.select("key", "node"), PIVOTS
    while True:
        labels = components(links)
        left = stored(_unsettled(left, labels))
        if left.isEmpty():
            return labels
        near = _group_pairs(left, nodes, percent, pivots).join(checked, ["a", "b"], "left_anti")
        near = stored(near)
        # What is connected stays so by one link from each node to its label.
        known = labels.select(F.col("label").alias("a"), F.col("node").alias("b"))
        links = stored(known.union(_checked_links(docs, near, nodes, percent, k)))
        checked = checked.union(near)
        left = left.filter(F.col("rank") > pivots).select("key", "node")
        pivots *= 16


def near_duplicates(docs: DataFrame, k: int = K, percent: int = 75) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every document.

    The component's id is the smallest ``doc_id`` that links lead to.
    """
    small_batches(docs.sparkSession)
    rows = stored(shingle_nodes(docs, k))
    usable = rows.filter("size > 0 and doc_id is not null")
    classes = stored(
        usable.groupBy("node").agg(
            F.min("doc_id").alias("doc_id"),
            F.max("size").alias("size"),
            F.max("sketch").alias("sketch"),
        )
    )
    named = docs.filter(F.col("doc_id").isNotNull())
    labels = similar_nodes(named, classes.filter("size >= 3"), k, percent)
    own = classes.select("node", "doc_id")
    least = stored(
        labels.join(own, "node").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    )
    joined = stored(labels.join(least, "label").select("node", "component_id"))
    ids = stored(
        own.join(joined, "node", "left").select(
            "node", F.coalesce("component_id", "doc_id").alias("component_id")
        )
    )
    found = rows.select("doc_id", "size", "node").join(ids, "node", "left")
    alone = (F.col("size") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id", F.col("size").alias("n_shingles"), component.alias("component_id")
    )


def one_of_each(docs: DataFrame, k: int = K, percent: int = 75) -> DataFrame:
    """The documents whose id is that of their component, each once.

    Rows with a null id all stay. Rows with equal ids and texts count as one document.
    Other columns stay, whatever their names.
    """
    plain, names = shielded(docs, ["doc_id", "text"])
    found = near_duplicates(plain, k, percent)
    kept = stored(found.filter("doc_id = component_id").select("doc_id").distinct())
    copies = Window.partitionBy("doc_id", "digest").orderBy(F.lit(0))
    named = (
        plain.join(kept, "doc_id", "left_semi")
        .withColumn("digest", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
        .withColumn("copy", F.row_number().over(copies))
        .filter("copy = 1")
    )
    own = named.select(plain.columns).union(plain.filter(F.col("doc_id").isNull()))
    return unshielded(own, names)
