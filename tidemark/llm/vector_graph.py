"""Nearest neighbours by inner product, with a robust-pruned graph for each shard.

Vectors are dealt by hash to shards of at most about ``SHARD_ROWS`` distinct vectors.
A shard has a graph for each band of lengths (``BAND`` times from end to end), whose
vectors get one more, short coordinate that makes them equally long, so the largest
inner product is the least distance. They are inserted into a directed graph
in batches: a greedy search for each proposes the nodes it came by as neighbours,
and relaxed pruning keeps the nearest one, drops those that are ``ALPHA`` times
nearer to it than to the new node, and goes on with the next. Edges are added in both
directions; a node above its degree is pruned again, and one that pruning cuts off is
given an edge more, so that every row can be found. A query runs a beam search in
every shard; what the beams end with is scored in doubles on the original vectors,
and the best of all shards are merged.

Equal vectors are one node. It keeps the ``most + 1`` smallest ids: more of them can
never be among ``most`` results, ties going to smaller ids, so nothing is lost and a
vector that a third of all rows share is one node, found with all its answers.

Every row is indexed and every query meets every shard. Queries go in blocks of about
``BLOCK_BYTES``, which are all that the driver holds and workers are sent.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite
components take no part; vectors are compared with those of their own length only;
repeated rows of one id and vector are one row; rows of one id with different vectors
are queries of their own, and a query's candidates are all rows of other ids; a NULL
id is a candidate, after all others of its score. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import best_rows, keep, table

NEAREST = 20
SHARD_ROWS = 8192
BLOCK_BYTES = 32 << 20
#: Edges of a node, nodes of a beam while building and searching, relaxation.
DEGREE = 40
BUILD_BEAM = 64
SEARCH_BEAM = 128
ALPHA = 1.1
#: Longest over shortest vector of a graph: one more coordinate bends few distances.
BAND = 1.3
#: Nodes inserted, and queries searched, at once.
BATCH = 256

GRAPH = "shard int, band long, node int, vec_ids array<long>, vector array<double>, edges array<int>"


def beam_search(
    queries: np.ndarray, data: np.ndarray, edges: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, distances) that each query's beam ends with, and the nodes it opened.

    Starts at node 0. ``-1`` pads nodes and edges; distances are negative inner products.
    """
    count = len(queries)
    seen = np.zeros((count, len(data)), bool)
    beam = np.full((count, width), -1, np.int32)
    far = np.full((count, width), np.inf)
    still = np.zeros((count, width), bool)
    beam[:, 0], far[:, 0], still[:, 0], seen[:, 0] = 0, -(queries @ data[0]), True, True
    opened = []
    while True:
        waiting = np.where(still, far, np.inf)
        pick = waiting.argmin(axis=1)
        rows = np.flatnonzero(waiting[np.arange(count), pick] < np.inf)
        if not len(rows):
            return beam, far, np.stack(opened, axis=1)
        nodes = np.full(count, -1, np.int32)
        nodes[rows] = beam[rows, pick[rows]]
        opened.append(nodes)
        still[rows, pick[rows]] = False
        near = edges[nodes[rows]]
        new = (near >= 0) & ~seen[rows[:, None], near]
        at, _ = np.nonzero(new)
        seen[rows[at], near[new]] = True
        away = np.full(near.shape, np.inf)
        away[new] = -np.einsum("ij,ij->i", data[near[new]], queries[rows[at]])
        nodes_all = np.concatenate([beam[rows], np.where(new, near, -1)], axis=1)
        far_all = np.concatenate([far[rows], away], axis=1)
        still_all = np.concatenate([still[rows], new], axis=1)
        order = np.argsort(far_all, axis=1, kind="stable")[:, :width]
        beam[rows] = np.take_along_axis(nodes_all, order, axis=1)
        far[rows] = np.take_along_axis(far_all, order, axis=1)
        still[rows] = np.take_along_axis(still_all, order, axis=1)


def robust_prune(
    points: np.ndarray, found: np.ndarray, data: np.ndarray, degree: int, alpha: float
) -> np.ndarray:
    """At most ``degree`` diverse neighbours of each point among ``found`` (padded with -1)."""
    found = np.sort(found, axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    vectors = data[found]
    # All vectors are equally long: half the squared distance is 1 - inner product.
    away = 1 - np.einsum("bcd,bd->bc", vectors, data[points])
    away[(found < 0) | (found == points[:, None])] = np.inf
    between = 1 - vectors @ vectors.transpose(0, 2, 1)
    rows = np.arange(len(points))
    out = np.full((len(points), degree), -1, np.int32)
    for place in range(degree):
        pick = away.argmin(axis=1)
        some = away[rows, pick] < np.inf
        if not some.any():
            break
        out[some, place] = found[some, pick[some]]
        away[alpha * alpha * between[rows, pick] <= away] = np.inf
        away[rows, pick] = np.inf
    return out


def _linked_back(points: np.ndarray, edges: np.ndarray, data: np.ndarray, alpha: float) -> None:
    """Adds the edges back to ``points`` from their neighbours, pruning full nodes."""
    degree = edges.shape[1]
    own = edges[points]
    pairs = np.stack([own[own >= 0], np.repeat(points, (own >= 0).sum(axis=1))], axis=1)
    while len(pairs):
        # At most ``degree`` new edges of a node in one go, the others in the next.
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        targets, first, counts = np.unique(pairs[:, 0], return_index=True, return_counts=True)
        place = np.arange(len(pairs)) - np.repeat(first, counts)
        now, pairs_left = pairs[place < degree], pairs[place >= degree]
        more = np.full((len(targets), degree), -1, np.int32)
        more[np.searchsorted(targets, now[:, 0]), place[place < degree]] = now[:, 1]
        both = np.concatenate([edges[targets], more], axis=1)
        both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)
        fits = (both >= 0).sum(axis=1) <= degree
        edges[targets[fits]] = both[fits, :degree]
        for at in range(0, int((~fits).sum()), BATCH):
            full = np.flatnonzero(~fits)[at : at + BATCH]
            edges[targets[full]] = robust_prune(targets[full], both[full], data, degree, alpha)
        pairs = pairs_left


def _reached(edges: np.ndarray) -> np.ndarray:
    """Which nodes a path leads to from node 0."""
    reached = np.zeros(len(edges), bool)
    front = np.array([0])
    while len(front):
        reached[front] = True
        front = np.unique(edges[front])
        front = front[front >= 0]
        front = front[~reached[front]]
    return reached


def _all_reached(edges: np.ndarray) -> np.ndarray:
    """``edges``, with one more to each node that pruning has cut off."""
    while True:
        reached = _reached(edges)
        lost = np.flatnonzero(~reached)
        if not len(lost):
            return edges
        # From the nearest of its own neighbours that is reached, else from node 0.
        own = edges[lost]
        known = (own >= 0) & reached[own]
        parents = np.where(known.any(axis=1), own[np.arange(len(lost)), known.argmax(axis=1)], 0)
        parents, first = np.unique(parents, return_index=True)
        more = np.full((len(edges), 1), -1, np.int32)
        more[parents, 0] = lost[first]
        edges = np.concatenate([edges, more], axis=1)


def equally_long(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled together and lengthened by one coordinate to length 1."""
    scaled = vectors / np.abs(vectors).max()
    squares = np.einsum("ij,ij->i", scaled, scaled)
    most = squares.max()
    rest = np.sqrt(np.maximum(1 - squares / most, 0))
    return np.concatenate([scaled / np.sqrt(most), rest[:, None]], axis=1)


def grow_graph(
    vectors: np.ndarray, degree: int = DEGREE, width: int = BUILD_BEAM, alpha: float = ALPHA
) -> tuple[np.ndarray, np.ndarray]:
    """(order, edges): nodes are ``vectors[order]``, and every search starts at node 0."""
    data = equally_long(vectors)
    middle = int((data @ data.mean(axis=0)).argmax())
    order = np.random.default_rng(len(data)).permutation(len(data))
    order = np.concatenate([[middle], order[order != middle]])
    data = data[order]
    edges = np.full((len(data), degree), -1, np.int32)
    done = 1
    while done < len(data):
        points = np.arange(done, min(len(data), done + min(BATCH, done)), dtype=np.int32)
        _, _, opened = beam_search(data[points], data, edges, width)
        edges[points] = robust_prune(points, opened, data, degree, alpha)
        _linked_back(points, edges, data, alpha)
        done += len(points)
    return order, _all_reached(edges)


def usable(vector: str | Column) -> Column:
    """Whether a vector has a direction: finite components, not all of them zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def rows_of(table_rows: DataFrame, vector: str) -> DataFrame:
    """(vec_id, vector) of the distinct usable rows, in doubles."""
    rows = table_rows.select(F.col("vec_id").cast("long"), F.col(vector).cast("array<double>").alias("vector"))
    return rows.filter(usable("vector")).distinct()


def _graphs_of(vectors: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(band, places, vectors) of the vectors of one number of coordinates and one band."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat, starts = vectors.flatten().to_numpy(), np.cumsum(sizes) - sizes
    for width in np.unique(sizes):
        mine = np.flatnonzero(sizes == width)
        own = flat[starts[mine][:, None] + np.arange(width)]
        largest = np.abs(own).max(axis=1)
        length = np.log(largest) + np.log(np.linalg.norm(own / largest[:, None], axis=1))
        # Equal lengths fall in the middle of a band, however they are rounded.
        bands = np.floor((length - length.max()) / np.log(BAND) + 0.5).astype(np.int64)
        for band in np.unique(bands):
            inside = bands == band
            yield int(band), mine[inside], own[inside]


def build_graph(rows: DataFrame, most: int = NEAREST, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The graph (``GRAPH``) of ``rows(vec_id, vector)``: a row for each distinct vector.

    ``most`` is the largest number of neighbours the graph will be asked for.
    """
    by_id = Window.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last())
    rows = rows.withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= most + 1)
    named = F.struct(F.col("place"), F.col("vec_id"))
    nodes = rows.groupBy("vector").agg(F.sort_array(F.collect_list(named)).alias("named"))
    nodes = keep(nodes.select("vector", F.transform("named", lambda x: x.vec_id).alias("vec_ids")))
    widest, count = nodes.agg(F.max(F.size("vector")), F.count("*")).first()
    shards = max(1, -(-count // min(shard_rows, max(1, BLOCK_BYTES // (8 * (widest or 1))))))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        for band, mine, own in _graphs_of(whole.column("vector").combine_chunks()):
            order, edges = grow_graph(own)
            kept = edges >= 0
            ends = np.concatenate([[0], np.cumsum(kept.sum(axis=1))]).astype(np.int32)
            part = whole.take(pa.array(mine[order])).combine_chunks()
            columns = [
                part.column("shard").combine_chunks(),
                pa.array(np.full(len(order), band)),
                pa.array(np.arange(len(order), dtype=np.int32)),
                part.column("vec_ids").combine_chunks(),
                part.column("vector").combine_chunks(),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(edges[kept])),
            ]
            names = [c.split(" ")[0] for c in GRAPH.split(", ")]
            yield from pa.Table.from_arrays(columns, names).to_batches(max_chunksize=1024)

    dealt = nodes.withColumn("shard", F.expr(f"CAST(pmod(xxhash64(vector), {shards}) AS INT)"))
    dealt = dealt.repartitionById(shards, "shard")
    return keep(dealt.select("shard", "vec_ids", "vector").mapInArrow(build, GRAPH))


class Shard:
    """One graph of a shard, read from its rows."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("node")
        vectors, edges = rows.column("vector").combine_chunks(), rows.column("edges").combine_chunks()
        self.vectors = vectors.flatten().to_numpy().reshape(len(rows), -1)
        self.data = equally_long(self.vectors)
        sizes = np.diff(edges.offsets.to_numpy())
        self.edges = np.full((len(rows), max(1, sizes.max())), -1, np.int32)
        self.edges[np.arange(self.edges.shape[1]) < sizes[:, None]] = edges.flatten().to_numpy()
        ids = rows.column("vec_ids").combine_chunks()
        self.named = np.diff(ids.offsets.to_numpy())
        self.first = np.cumsum(self.named) - self.named
        flat = ids.flatten()
        self.nameless = flat.is_null().to_numpy(zero_copy_only=False)
        self.ids = flat.fill_null(0).to_numpy()

    def nearest(self, own: np.ndarray, queries: np.ndarray, most: int, width: int) -> tuple[np.ndarray, ...]:
        """(query's place, id, no id, score) of the ``most`` nearest found for each query."""
        directions = queries / np.abs(queries).max(axis=1, keepdims=True)
        directions /= np.linalg.norm(directions, axis=1, keepdims=True)
        padded = np.concatenate([directions, np.zeros((len(queries), 1))], axis=1)
        beam, _, _ = beam_search(padded, self.data, self.edges, width)
        query, at = np.nonzero(beam >= 0)
        node = beam[query, at]
        score = np.einsum("ij,ij->i", self.vectors[node], queries[query])
        times = self.named[node]
        place = np.repeat(self.first[node] - np.cumsum(times) + times, times) + np.arange(times.sum())
        query, score = np.repeat(query, times), np.repeat(score, times)
        ids, nameless = self.ids[place], self.nameless[place]
        other = nameless | (ids != own[query])
        query, score, ids, nameless = query[other], score[other], ids[other], nameless[other]
        order = np.lexsort((ids, nameless, -score, query))
        query, score, ids, nameless = query[order], score[order], ids[order], nameless[order]
        starts = np.searchsorted(query, query)
        best = np.arange(len(query)) - starts < most
        return query[best], ids[best], nameless[best], score[best]


def _block(queries: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(number, id, vector) arrays of a block's queries by the vectors' length."""
    whole = queries.toArrow()
    vectors = whole.column("vector").combine_chunks()
    if not len(whole):
        return {}
    sizes = np.diff(vectors.offsets.to_numpy())
    flat, starts = vectors.flatten().to_numpy(), np.cumsum(sizes) - sizes
    ids, out = whole.column("vec_id").to_numpy(), {}
    for width in np.unique(sizes):
        mine = np.flatnonzero(sizes == width)
        out[int(width)] = mine, ids[mine], flat[starts[mine][:, None] + np.arange(width)]
    return out


def _searched(graph: DataFrame, block: dict, most: int, width: int) -> DataFrame:
    """(query, query_id, vec_id, score, task) of each shard's nearest."""
    columns = [("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
    shape = pa.schema([*columns, ("task", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        task = whole.column("shard")[0].as_py()
        sizes = np.diff(whole.column("vector").combine_chunks().offsets.to_numpy())
        bands = whole.column("band").to_numpy()
        for size, band in np.unique(np.stack([sizes, bands], axis=1), axis=0):
            if size not in block:
                continue
            numbers, ids, vectors = block[size]
            shard = Shard(whole.take(pa.array(np.flatnonzero((sizes == size) & (bands == band)))))
            for at in range(0, len(ids), BATCH):
                part = slice(at, at + BATCH)
                query, found, nameless, score = shard.nearest(ids[part], vectors[part], most, width)
                arrays = [
                    pa.array(numbers[part][query], pa.int64()),
                    pa.array(ids[part][query], pa.int64()),
                    pa.array(found, pa.int64(), mask=nameless),
                    pa.array(score),
                    pa.array(np.full(len(query), task), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=shape)

    kinds = "query long, query_id long, vec_id long, score double, task long"
    return graph.mapInArrow(run, kinds)


def search_graph(
    graph: DataFrame, queries: DataFrame, most: int = NEAREST, width: int = SEARCH_BEAM, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """query_id, rank, vec_id, score of each query's ``most`` nearest found.

    ``queries`` has (vec_id, vector); rows of its own id are no candidates.
    """
    queries = keep(queries.select("vec_id", "vector"))
    size = queries.agg(F.sum(8 * F.size("vector"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    shards = (graph.agg(F.max("shard")).first()[0] or 0) + 1
    dealt = graph.repartitionById(shards, "shard")
    answers = None
    for number in range(blocks):
        block = _block(queries.filter(F.expr(f"pmod(xxhash64(vec_id, vector), {blocks}) = {number}")))
        found = _searched(dealt, block, most, max(width, most + 1))
        found = best_rows(found, ["query"], [F.col("score").desc(), F.col("vec_id").asc_nulls_last()], most)
        found = found.select("query_id", F.col("place").alias("rank"), "vec_id", "score")
        found = keep(found) if blocks > 1 else found
        answers = found if answers is None else answers.unionByName(found)
    return answers


def op12_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rows_of(table(spark, sf_dir, "embeddings"), "embedding")
    return search_graph(build_graph(rows), rows.filter(F.col("vec_id") % 20 == 0))
