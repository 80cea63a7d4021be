"""Ranked lexical search, exact, with ball trees of sparse document vectors.

A document is the vector of its integer impacts on the items' terms, an item the
vector of its integer term weights, and a score their inner product. Documents are
dealt to shards of bounded size. Each shard is a ball tree: a node is a set of
documents with their centroid and the radius around it that holds them all, split
between the two documents that lie far apart until few are left. For an item ``p``
no document of a ball scores above ``p . centroid + |p| * radius``, nor above
``p . (centroid + radii)`` with the radius in each coordinate for itself; the lesser
of the two bounds the ball. (On sparse texts the first alone passes over nothing.)
Balls are opened best first; once the best bound is below the least of the ``k`` best
scores found, all other balls are passed over. Documents of a leaf are scored in
integers.

Bounds are computed in doubles and rounded up by more than their arithmetic can
lose, and a ball is only passed over if its bound is strictly below the least score,
so ties are found too: results are exact. Distances are taken in coordinates scaled
by the root of a term's weight (and items by its inverse), which leaves inner
products as they are and keeps words of every document from filling the balls.

Items are taken in blocks of at most ``BLOCK_TERMS`` terms; a block's terms and
weights are all that workers are sent. Counts are taken over all documents.

Defined results: a NULL text or one without a term takes no part and does not count;
rows of one doc_id are ranked each by itself; NULL ids follow all others of their
score; repeated items are answered each by itself; an item without a term, or one
that no document matches, has no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import best_rows, keep, table

TOP = 50
#: Terms of a block of items, each item's counted for itself.
BLOCK_TERMS = 100_000
#: Postings and documents of a shard.
SHARD_POSTINGS = 1_000_000
SHARD_DOCS = 16_384
LEAF = 32
#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 22
NO_ID = 1 << 63

_LETTERS = bytes(range(ord("A"), ord("Z") + 1))
_KEPT = bytes(range(ord("0"), ord("9") + 1)) + _LETTERS + _LETTERS.lower() + bytes(range(0x80, 0x100))
#: Characters between terms become spaces and capitals small; others stay.
_FOLD = bytes((b + 32 if b in _LETTERS else b) if b in _KEPT else 32 for b in range(256))


def term_counts(text: str | None) -> Counter:
    """How often each term (UTF-8 bytes) occurs in the whole text."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    counts: Counter = Counter()
    start = 0
    while start < len(data):
        stop = data.find(b" ", start + PIECE)
        stop = len(data) if stop < 0 else stop
        counts.update(data[start:stop].split())
        start = stop
    return counts


def postings(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term; ``terms`` are the known ones."""
    shape = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                ids, lengths, found, tfs, ends = [], [], [], [], [0]
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    counts = term_counts(text.as_py())
                    if not counts:
                        continue
                    ids.append(doc_id)
                    lengths.append(counts.total())
                    for term in counts.keys() & terms.keys():
                        found.append(terms[term])
                        tfs.append(counts[term])
                    ends.append(len(found))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (found, tfs)]
                arrays = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), *lists]
                yield pa.RecordBatch.from_arrays(arrays, schema=shape)

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


class Items:
    """A block of items: their terms, weights and scaled vectors."""

    def __init__(self, names: list[int | None], terms: list[list[int]], weights: np.ndarray):
        self.names = names
        lists = [np.array([t for t in ts if weights[t] > 0], np.int64) for ts in terms]
        self.terms = lists
        self.weights = weights
        self.scale = np.sqrt(weights.astype(np.float64))
        self.filled = [i for i, ts in enumerate(lists) if len(ts)]
        self.flat = np.concatenate([lists[i] for i in self.filled] or [np.zeros(0, np.int64)])
        sizes = np.array([len(lists[i]) for i in self.filled], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        # |p|, rounded up: its square is the exact sum of the weights.
        sums = np.array([int(weights[lists[i]].sum()) for i in self.filled], np.float64)
        self.norms = np.sqrt(sums) * (1 + 2.0**-50)
        self.slack = (sizes + 32) * 2.0**-52

    def bounds(self, centroid: np.ndarray, radius: float, radii: np.ndarray) -> np.ndarray:
        """No document of the ball scores above its item's bound."""
        inner, most = (
            np.add.reduceat(self.scale[self.flat] * v[self.flat], self.starts) for v in (centroid, centroid + radii)
        )
        return np.minimum(inner + self.norms * radius, most) * (1 + 8 * self.slack) + 1


class Ball:
    """A node of the tree over rows ``ids``; leaves hold their postings."""

    __slots__ = ("bounds", "children", "ids", "starts", "cols", "impacts")


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts)


def _chosen(order: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the postings of rows ``order``, and where each row starts among them."""
    picked = sizes[order]
    ends = np.cumsum(picked)
    first = ends - picked
    return np.repeat(starts[order] - first, picked) + np.arange(ends[-1]), first


def grow(ids: np.ndarray, starts: np.ndarray, cols: np.ndarray, impacts: np.ndarray, items: Items, leaf: int) -> Ball:
    """The ball tree of documents given by rows of postings, none of them empty."""
    ball = Ball()
    sizes = np.diff(np.append(starts, len(cols)))
    values = impacts * items.scale[cols]
    centroid = np.bincount(cols, weights=values, minlength=len(items.scale)) / len(ids)
    squares = _sums(values * values, starts)
    middle = float(centroid @ centroid)
    apart = squares - 2 * _sums(values * centroid[cols], starts) + middle
    # The difference loses what the sums lose: allow for it before the root.
    lost = 8 * (sizes.max() + len(ids) + 64) * 2.0**-52 * (squares.max() + middle)
    radius = math.sqrt(max(float(apart.max()), 0.0) + lost) * (1 + 2.0**-50)
    radii = np.zeros(len(centroid))
    np.maximum.at(radii, cols, values - centroid[cols])
    ball.bounds = items.bounds(centroid, radius, radii)
    if len(ids) <= leaf:
        ball.children = None
        ball.ids, ball.starts, ball.cols, ball.impacts = ids, starts, cols, impacts
        return ball

    def row(i: int) -> np.ndarray:
        dense = np.zeros(len(items.scale))
        dense[cols[starts[i] : starts[i] + sizes[i]]] = values[starts[i] : starts[i] + sizes[i]]
        return dense

    one = row(int(apart.argmax()))
    far = squares - 2 * _sums(values * one[cols], starts)
    along = _sums(values * (one - row(int(far.argmax())))[cols], starts)
    order = np.argsort(along, kind="stable")
    ball.children = []
    for half in (order[: len(order) // 2], order[len(order) // 2 :]):
        at, first = _chosen(half, starts, sizes)
        ball.children.append(grow(ids[half], first, cols[at], impacts[at], items, leaf))
    return ball


class Best:
    """The ``k`` best (score, id) of an item, ties to smaller ids."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    @property
    def least(self) -> int:
        """What a document has to reach; a score of 0 is none."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def add(self, score: int, doc_id: int) -> None:
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, (score, -doc_id))
        elif (score, -doc_id) > self.heap[0]:
            heapq.heapreplace(self.heap, (score, -doc_id))


def search_tree(root: Ball, items: Items, best: list[Best]) -> int:
    """Adds a tree's documents to the best of each item; returns the leaves opened."""
    opened = 0
    weights = np.zeros(len(items.weights), np.int64)
    for place, item in enumerate(items.filled):
        own, terms = best[item], items.terms[item]
        weights[terms] = items.weights[terms]
        queue = [(-root.bounds[place], 0, root)]
        number = 1
        while queue and -queue[0][0] >= own.least:
            ball = heapq.heappop(queue)[2]
            if ball.children is None:
                opened += 1
                scores = _sums(ball.impacts * weights[ball.cols], ball.starts)
                for i in np.flatnonzero(scores >= own.least):
                    own.add(int(scores[i]), int(ball.ids[i]) if ball.ids[i] is not None else NO_ID)
                continue
            for child in ball.children:
                if child.bounds[place] >= own.least:
                    heapq.heappush(queue, (-child.bounds[place], number, child))
                    number += 1
        weights[terms] = 0
    return opened


def impacts_of(tfs: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tfs) // (1000 * tfs + 20 * m)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches, cut and gathered to at most a shard's documents and about its postings."""
    held, docs, known = [], 0, 0
    for batch in batches:
        for at in range(0, len(batch), 1024):
            part = batch.slice(at, 1024)
            held.append(part)
            docs += len(part)
            known += len(part.column("terms").flatten())
            if docs >= SHARD_DOCS or known >= SHARD_POSTINGS:
                yield held
                held, docs, known = [], 0, 0
    if held:
        yield held


def _tree(held: list[pa.RecordBatch], items: Items, documents: int, total: int, leaf: int) -> Ball | None:
    ids, sizes, cols, tfs, ms = [], [], [], [], []
    for batch in held:
        ids += batch.column("doc_id").to_pylist()
        lists = batch.column("terms")
        sizes.append(np.diff(lists.offsets.to_numpy()))
        cols.append(lists.flatten().to_numpy())
        tfs.append(batch.column("tfs").flatten().to_numpy())
        # Python's integers: the product may be above 64 bits.
        ms += [50 + 50 * n * documents // total for n in batch.column("n").to_pylist()]
    size, col = np.concatenate(sizes).astype(np.int64), np.concatenate(cols).astype(np.int64)
    impact = impacts_of(np.concatenate(tfs).astype(np.int64), np.repeat(np.array(ms, np.int64), size))
    row = np.repeat(np.arange(len(size)), size)
    useful = (items.weights[col] > 0) & (impact > 0)
    col, impact, row = col[useful], impact[useful], row[useful]
    if not len(col):
        return None
    rows, starts = np.unique(row, return_index=True)
    names = np.array(ids, object)[rows]
    return grow(names, starts, col, impact, items, leaf)


def _searched(rows: DataFrame, items: Items, documents: int, total: int, k: int, leaf: int) -> DataFrame:
    """(item, item_id, doc_id, score, task): each task's best documents of every item."""
    shape = pa.schema([(c, pa.int64()) for c in ("item", "item_id", "doc_id", "score", "task")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        best = [Best(k) for _ in items.names]
        for held in _shards(batches):
            tree = _tree(held, items, documents, total, leaf)
            if tree is not None:
                search_tree(tree, items, best)
        task = TaskContext.get().partitionId()
        for item, own in enumerate(best):
            out = [
                (item, items.names[item], None if -less == NO_ID else -less, score, task) for score, less in own.heap
            ]
            if out:
                arrays = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=shape)

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in shape.names))


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with their distinct terms, read one after another and held a block at a time."""
    held, size = [], 0
    for row in items.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        terms = sorted(term_counts(row.text))
        if held and size + len(terms) > most:
            yield held
            held, size = [], 0
        if terms:
            held.append((row.item_id, terms))
            size += len(terms)
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS, leaf: int = LEAF) -> DataFrame:
    """The ``k`` documents with the highest scores for every row of ``items(item_id, text)``.

    Returns item_id, rank (from 1), doc_id, score.
    """
    answers = None
    for block in _blocks(items, block_terms):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}))}
        rows = keep(postings(docs, vocabulary))
        documents, total = rows.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            break
        held = rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        found = {r.term: r["count"] for r in held}  # at most the block's terms
        odds = [(2 * documents + 2) / (2 * found.get(i, 0) + 1) for i in range(len(vocabulary))]
        weights = np.array([math.floor(1000 * math.log(x)) for x in odds], np.int64)
        of = Items([name for name, _ in block], [[vocabulary[t] for t in terms] for _, terms in block], weights)
        best = _searched(rows, of, documents, total, k, leaf)
        best = best_rows(best, ["item"], [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], k)
        best = keep(best.select("item_id", F.col("place").alias("rank"), "doc_id", "score"))
        answers = best if answers is None else answers.unionByName(best)
    if answers is None:
        spark = docs.sparkSession
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return answers


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH cut AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS terms
  FROM documents),
docs AS (SELECT r, doc_id, terms, len(terms) AS n FROM cut WHERE len(terms) > 0),
whole AS (SELECT count(*) AS documents, sum(n)::BIGINT AS total FROM docs),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
items AS (
  SELECT item, item_id, unnest(list_distinct(terms)) AS term FROM (
    SELECT row_number() OVER () AS item, item_id,
      regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS terms
    FROM benchmark)),
weights AS (
  SELECT term, floor(1000 * ln((2 * documents + 2) / (2 * df + 1)))::BIGINT AS w FROM df, whole),
lengths AS (SELECT r, doc_id, 50 + ((50 * n * documents) // total) AS m FROM docs, whole),
scores AS (
  SELECT i.item, i.item_id, l.doc_id, t.r,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM items i JOIN weights USING (term) JOIN tf t USING (term) JOIN lengths l ON l.r = t.r
  GROUP BY i.item, i.item_id, l.doc_id, t.r),
places AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place
  FROM scores WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM places WHERE place <= 50
"""
