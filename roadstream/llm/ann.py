"""Approximate nearest neighbours by robust-pruned directed graphs.

Vectors are dealt by hash of their id into shards of a fixed size. Each shard's graph
starts at random; then each vector in turn searches the graph greedily, the vectors it
meets are its candidate neighbours, and pruning keeps a candidate only if no nearer kept
one is closer to it by the factor ``alpha``, so that few but diverse edges remain. Edges
go both ways; a vector with too many is pruned again. Many vectors search at once, by
array operations. A query is answered by a beam search in every shard of its dimension;
the found vectors' distances are computed in double precision, and the nearest of all
shards are kept.

Equal vectors of a shard are one node of its graph with all their ids, so copies
neither crowd out others nor get lost.

Rows: vectors that are null, empty, zero or hold nulls, NaN or infinities take no part,
nor do null ids. Of rows with equal ids the least vector counts. Vectors meet only those
of the same length. With fewer than ``k`` candidates all are returned. Ties go to the
smaller id. Other columns are ignored. An empty table, or one without queries, gives no
rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.store import stored

SHARD_ROWS = 5000
DEGREE, WIDEST = 32, 48  # edges kept by pruning; edges at which a vector is pruned
BUILD_BEAM, QUERY_BEAM = 64, 128
EXPANDED = 4  # vectors of a beam whose edges are followed at once
ALPHAS = (1.0, 1.2)
BATCH = 256


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``vector`` (doubles) and ``dim`` of the rows that take part."""
    column = F.col(vector).cast("array<double>")
    good = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.filter(
        F.col("vec_id").isNotNull() & good & F.exists(column, lambda x: x != 0.0)
    )
    one = kept.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(
        F.min(column).alias("vector")
    )
    return one.withColumn("dim", F.size("vector"))


def beam_search(
    x: np.ndarray, norms: np.ndarray, graph: np.ndarray, entry: int, q: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Nodes nearest to each row of ``q``, nearest first, and squared distances less the
    query's norm; -1 and infinity where there are fewer than ``width``.

    ``graph`` has a row of neighbours for each node, filled up with -1.
    """
    n, rows = len(q), np.arange(len(q))[:, None]
    seen = np.zeros((n, len(x) + 1), bool)  # the last column stands for -1
    seen[:, -1] = seen[:, entry] = True
    ids = np.full((n, width), -1)
    far = np.full((n, width), np.inf, np.float32)
    opened = np.ones((n, width), bool)
    ids[:, 0], far[:, 0], opened[:, 0] = entry, norms[entry] - 2 * (q @ x[entry]), False
    while True:
        order = np.argsort(opened, axis=1, kind="stable")[:, :EXPANDED]
        fresh = ~np.take_along_axis(opened, order, 1)
        live = np.flatnonzero(fresh[:, 0])
        if not len(live):
            return ids, far
        order, fresh = order[live], fresh[live]
        opened[live[:, None], order] = True
        from_ids = np.where(fresh, ids[live[:, None], order], -1)
        near = np.where((from_ids >= 0)[:, :, None], graph[from_ids], -1).reshape(len(live), -1)
        near.sort(axis=1)
        new = ~seen[live[:, None], near]
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[live[:, None], near] = True
        reach = norms[near] - 2 * np.einsum("brd,bd->br", x[near], q[live])
        reach = np.where(new, reach, np.inf)
        all_far = np.concatenate([far[live], reach], axis=1)
        all_ids = np.concatenate([ids[live], np.where(new, near, -1)], axis=1)
        all_opened = np.concatenate([opened[live], ~new], axis=1)
        best = np.argpartition(all_far, width - 1, axis=1)[:, :width]
        best = np.take_along_axis(
            best, np.argsort(np.take_along_axis(all_far, best, 1), axis=1, kind="stable"), 1
        )
        ids[live] = np.take_along_axis(all_ids, best, 1)
        far[live] = np.take_along_axis(all_far, best, 1)
        opened[live] = np.take_along_axis(all_opened, best, 1)


def robust_prune(
    x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, alpha: float, degree: int
) -> np.ndarray:
    """At most ``degree`` diverse neighbours of each node from a row of candidates (-1:
    none), filled up with -1."""
    valid = (candidates >= 0) & (candidates != nodes[:, None])
    points = x[candidates]
    far = ((points - x[nodes][:, None, :]) ** 2).sum(axis=2)
    far = np.where(valid, far, np.inf)
    order = np.argsort(far, axis=1, kind="stable")
    candidates = np.take_along_axis(candidates, order, 1)
    far = np.take_along_axis(far, order, 1)
    points = np.take_along_axis(points, order[:, :, None], 1)
    norms = (points**2).sum(axis=2)
    alive = np.isfinite(far)
    out = np.full((len(nodes), degree), -1)
    rows = np.arange(len(nodes))
    for k in range(degree):
        pick = alive.argmax(axis=1)
        some = alive[rows, pick]
        if not some.any():
            break
        out[:, k] = np.where(some, candidates[rows, pick], -1)
        chosen = points[rows, pick]
        between = norms + norms[rows, pick][:, None] - 2 * np.einsum("bcd,bd->bc", points, chosen)
        # The pick itself and further copies of it have distance 0 and go too.
        alive &= ~((alpha**2 * between <= far) & some[:, None])
        alive[rows, pick] = False
    return out


def _add_back_edges(x, graph, nodes, kept, alpha) -> None:
    """Edges back to ``nodes`` from their kept neighbours; full rows are pruned."""
    source = np.repeat(nodes, kept.shape[1])[kept.ravel() >= 0]
    target = kept.ravel()[kept.ravel() >= 0]
    there = (graph[target] == source[:, None]).any(axis=1)
    source, target = source[~there], target[~there]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    first = np.searchsorted(target, target)
    turn = np.arange(len(target)) - first
    room = WIDEST - DEGREE
    for start in range(0, int(turn.max(initial=-1)) + 1, room):
        now = (turn >= start) & (turn < start + room)
        own, at = np.unique(target[now], return_inverse=True)
        extra = np.full((len(own), room), -1)
        extra[at, turn[now] - start] = source[now]
        row = np.concatenate([graph[own], extra], axis=1)
        row = np.take_along_axis(row, np.argsort(row < 0, axis=1, kind="stable"), 1)
        full = (row >= 0).sum(axis=1) > WIDEST
        graph[own[~full]] = row[~full, :WIDEST]
        if full.any():
            graph[own[full]] = -1
            graph[own[full], :DEGREE] = robust_prune(x, own[full], row[full], alpha, DEGREE)


def build_graph(x: np.ndarray, seed: int) -> tuple[np.ndarray, int]:
    """Neighbours of each row of ``x`` (-1: none) and the entry node."""
    n = len(x)
    graph = np.full((n, WIDEST), -1)
    norms = (x**2).sum(axis=1)
    entry = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
    random = np.random.default_rng(seed)
    start = random.integers(0, n, (n, min(DEGREE // 2, max(1, n - 1))))
    graph[:, : start.shape[1]] = np.where(start == np.arange(n)[:, None], -1, start)
    for alpha in ALPHAS:
        order = random.permutation(n)
        for begin in range(0, n, BATCH):
            nodes = order[begin : begin + BATCH]
            met = beam_search(x, norms, graph, entry, x[nodes], BUILD_BEAM)[0]
            candidates = np.concatenate([met, graph[nodes]], axis=1)
            candidates.sort(axis=1)
            again = candidates[:, 1:] == candidates[:, :-1]
            candidates[:, 1:][again] = -1
            kept = robust_prune(x, nodes, candidates, alpha, DEGREE)
            graph[nodes] = -1
            graph[nodes, :DEGREE] = kept
            _add_back_edges(x, graph, nodes, kept, alpha)
    return graph, entry


INDEX = (
    "dim int, shard int, node int, vec_ids array<long>, vector array<double>, "
    "neighbours array<int>, entry boolean"
)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    lists = column.combine_chunks()
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False)).reshape(len(lists), -1)


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Graphs of all shards, a row for each node (``INDEX``); every vector is in one.

    ``vectors`` comes from ``usable``. A task holds one shard.
    """
    shards = max(1, -(-vectors.count() // shard_rows))

    def shard_graph(table: pa.Table) -> pa.Table:
        dim, shard = table.column("dim")[0].as_py(), table.column("shard")[0].as_py()
        ids = table.column("vec_id").to_numpy()
        distinct, node = np.unique(_matrix(table.column("vector")), axis=0, return_inverse=True)
        node = node.reshape(-1)
        order = np.lexsort((ids, node))
        upto = np.cumsum(np.bincount(node, minlength=len(distinct)))
        graph, entry = build_graph(distinct.astype(np.float32), shard)
        return pa.table(
            {
                "dim": pa.array([dim] * len(distinct), pa.int32()),
                "shard": pa.array([shard] * len(distinct), pa.int32()),
                "node": pa.array(np.arange(len(distinct)), pa.int32()),
                "vec_ids": pa.array(np.split(ids[order], upto[:-1]), pa.list_(pa.int64())),
                "vector": pa.array(list(distinct), pa.list_(pa.float64())),
                "neighbours": pa.array([g[g >= 0] for g in graph], pa.list_(pa.int32())),
                "entry": pa.array(np.arange(len(distinct)) == entry),
            }
        )

    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    # By ranges, so that each task has about one shard; hashes would put several in some.
    dealt = vectors.withColumn("shard", shard).repartitionByRange(shards, "dim", "shard")
    return dealt.groupBy("dim", "shard").applyInArrow(shard_graph, INDEX)


FOUND = "query_id long, vec_id long, score double"


class Shard:
    """A shard's graph, and the exact search of what it finds."""

    def __init__(self, pieces: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(pieces).combine_chunks()
        self.exact = _matrix(rows.column("vector"))
        self.x = self.exact.astype(np.float32)
        lists = rows.column("neighbours").to_pylist()
        self.graph = np.full((len(lists), max(1, max(map(len, lists)))), -1)
        for i, own in enumerate(lists):
            self.graph[i, : len(own)] = own
        self.entry = int(np.argmax(rows.column("entry").to_numpy(zero_copy_only=False)))
        self.norms, self.members = (self.x**2).sum(axis=1), rows.column("vec_ids")

    def nearest(self, queries: pa.RecordBatch, k: int) -> pa.RecordBatch:
        """Each query's ``k`` nearest of the shard, without itself."""
        q = _matrix(pa.chunked_array([queries.column("vector")]))
        asked = [own[0] for own in queries.column("vec_ids").to_pylist()]
        ids = beam_search(
            self.x, self.norms, self.graph, self.entry, q.astype(np.float32), QUERY_BEAM
        )[0]
        far = np.sqrt(((self.exact[ids] - q[:, None, :]) ** 2).sum(axis=2))
        out = ([], [], [])
        for query, nodes, scores in zip(asked, ids, far, strict=True):
            own = scores[nodes >= 0]
            nodes = nodes[nodes >= 0]
            order = np.argsort(own, kind="stable")[: k + 1]
            # Nodes as far as the last one are candidates too, for their smaller ids.
            order = np.flatnonzero(own <= own[order[-1]])
            pairs = sorted(
                (float(own[i]), v)
                for i in order
                for v in self.members[int(nodes[i])].as_py()[: k + 1]
                if v != query
            )[:k]
            out[0].extend([query] * len(pairs))
            out[1].extend(v for _, v in pairs)
            out[2].extend(s for s, _ in pairs)
        kinds = (pa.int64(), pa.int64(), pa.float64())
        arrays = [pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])


def _pieces(batch: pa.RecordBatch):
    """Stretches of one shard's nodes or queries: ((dim, shard), is query, rows)."""
    dims, shards = batch.column("dim").to_numpy(), batch.column("shard").to_numpy()
    asked = batch.column("query").to_numpy(zero_copy_only=False)
    change = (np.diff(dims) != 0) | (np.diff(shards) != 0) | (np.diff(asked.astype(int)) != 0)
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(dims)]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        if begin < end:
            key = (int(dims[begin]), int(shards[begin]))
            yield key, bool(asked[begin]), batch.slice(begin, end - begin)


def search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest found for each query (vec_id, vector, dim), without itself:
    ``query_id``, ``rank``, ``vec_id``, ``score``.

    A task holds one shard at a time, and all queries stream past it, ``BATCH`` at once: the
    index moves once, however many queries there are.
    """
    # New column names tell the list of shards from the index itself.
    shards = index.select("dim", "shard").distinct().toDF("dim", "shard")
    asked = queries.join(F.broadcast(shards), "dim").select(
        "dim",
        "shard",
        F.lit(True).alias("query"),
        F.lit(None).cast("int").alias("node"),
        F.array("vec_id").alias("vec_ids"),
        "vector",
        F.lit(None).cast("array<int>").alias("neighbours"),
        F.lit(None).cast("boolean").alias("entry"),
    )
    nodes = index.withColumn("query", F.lit(False)).select(asked.columns)
    parts = max(1, shards.count())
    dealt = nodes.unionByName(asked).repartition(parts, "dim", "shard")
    in_order = dealt.sortWithinPartitions("dim", "shard", "query", "node")

    def found(batches):
        current, held, shard = None, [], None
        for batch in batches:
            for key, is_query, piece in _pieces(batch):
                if key != current:
                    current, held, shard = key, [], None
                if not is_query:
                    held.append(piece)
                    continue
                if shard is None:
                    shard, held = Shard(held), []
                for begin in range(0, piece.num_rows, BATCH):
                    yield shard.nearest(piece.slice(begin, BATCH), k)

    near = in_order.mapInArrow(found, FOUND)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def neighbours(
    table: DataFrame, is_query: Column, k: int = 10, vector: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest rows of ``table`` (vec_id, ``vector``) of those with ``is_query``."""
    vectors = stored(usable(table, vector))
    index = stored(build_index(vectors))
    return search(index, vectors.filter(is_query), k)
