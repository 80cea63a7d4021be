"""A Merkle manifest of a data set, by time-forward processing.

Every row is a leaf. The leaves of one source, in ascending order of id, are joined
in runs of ``FAN`` until one digest is left, the source's subroot; the subroots, in
order of source, are joined likewise into the root. Each row gets its proof: the
digests that lead from its leaf to the root.

The nodes are a graph whose edges lead from children to parents, labelled so that
every edge leads to a larger label. Nodes are processed in the order of labels, and
what a node has to say to its parent waits in a priority queue keyed by the parent's
label. The queue is external: Spark deals the nodes by ranges of labels and delivers
what crosses a range by a sorted shuffle, so a range gets its messages in order; what
stays within a range waits in a heap of at most ``span`` messages. A second sweep
takes the labels in descending order, and parents hand their children the rest of
their proofs.

A source is cut into ranges of ``span`` leaves (a power of ``FAN``), so a hot source
is many ranges. Positions come from a range-partitioned sort and one count for each
(source, task).

Defined results: a NULL field counts as ``-``; the NULL source is one source and
comes first; NULL ids come first in their source; rows of one id follow the order of
their leaves, and rows equal in all fields are leaves of their own. Columns beside
the five of a leaf are ignored. An empty table has no leaves and no root.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import crc_of_id, keep, ranked, small_side, table

FAN = 3
#: Leaves of a range: six levels of a tree.
SPAN = FAN**6
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

RUN = "struct<place: int, others: array<string>>"
#: What crosses ranges on the way down: the proof from a range's top upwards.
MESSAGE = f"tree string, range long, subroot string, proof array<{RUN}>"
NODE = ["tree", "pos", "size", "digest"]


def digest(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_digest(fields: dict[str, Column]) -> Column:
    """The leaf of a row: each field's byte count and value, or ``-``."""
    parts = []
    for name in FIELDS:
        value = fields[name].cast("string")
        counted = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(counted, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def levels_above(size: int, span: int) -> int:
    """Levels that a range of a tree with ``size`` nodes is joined up."""
    steps, width = 0, 1
    while width < size and width < span:
        steps, width = steps + 1, width * FAN
    return steps


def forward(digests: list[str], steps: int) -> dict[tuple[int, int], str]:
    """The digest of every node of a range by its label (level, place)."""
    queue = [(0, place, 0, value) for place, value in enumerate(digests)]
    done: dict[tuple[int, int], str] = {}
    while queue:
        label, told = queue[0][:2], []
        while queue and queue[0][:2] == label:
            told.append(heapq.heappop(queue)[3])
        level, place = label
        done[label] = digest(*told) if level else told[0]
        if level < steps:
            heapq.heappush(queue, (level + 1, place // FAN, place % FAN, done[label]))
    return done


def backward(nodes: dict[tuple[int, int], str], steps: int, above: list[dict]) -> list[list[dict]]:
    """The proof of every leaf of a range, given the proof of the range's top."""
    queue = [(-steps, 0, above)]
    proofs: list[list[dict]] = []
    while queue:
        level, place, proof = heapq.heappop(queue)
        level, place = -level, -place
        if not level:
            proofs.append(proof)
            continue
        run = range(FAN * place, FAN * place + FAN)
        children = [nodes[level - 1, p] for p in run if (level - 1, p) in nodes]
        for k in range(len(children)):
            others = children[:k] + children[k + 1 :]
            own = [{"place": k, "others": others}, *proof]
            heapq.heappush(queue, (1 - level, -(FAN * place + k), own))
    return proofs[::-1]


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each (tree, range), which follow each other."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and held[0][:2] != row[:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _in_ranges(nodes: DataFrame, span: int) -> DataFrame:
    names = ["tree", "range", *[c for c in nodes.columns if c != "tree"]]
    return nodes.withColumn("range", F.expr(f"pos div {span}")).select(*names)


def _per_range(dealt: DataFrame, work: Callable, schema: str, batch_rows: int = 2_000) -> DataFrame:
    """``work(rows)`` of every range, one after another in order of its label."""
    fields = dealt.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def packed() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        for rows in _ranges(batches):
            out.extend(work(rows))
            if len(out) >= batch_rows:
                yield packed()
                out.clear()
        if out:
            yield packed()

    ordered = dealt.repartition("tree", "range").sortWithinPartitions("tree", "range", "pos")
    return ordered.mapInArrow(run, fields)


def _joined(nodes: DataFrame, span: int) -> DataFrame:
    """The tops of all ranges: the nodes of the next tier."""

    def work(rows: list[tuple]) -> list[tuple]:
        tree, place, _, size, _ = rows[0]
        steps = levels_above(size, span)
        top = forward([r[4] for r in rows], steps)[steps, 0]
        return [(tree, place, -(-size // span), top)]

    dealt = _in_ranges(nodes.select(*NODE), span)
    return keep(_per_range(dealt, work, "tree string, pos long, size long, digest string"))


def tiers(nodes: DataFrame, span: int) -> list[DataFrame]:
    """``nodes`` and the tops of their ranges, up to one node for each tree."""
    out = [nodes]
    while (out[-1].agg(F.max("size")).first()[0] or 0) > 1:
        out.append(_joined(out[-1], span))
    return out


def _swept(nodes: DataFrame, messages: DataFrame, span: int, schema: str, told: Callable) -> DataFrame:
    """``told(row, subroot, proof)`` of every node; a row starts (tree, range, pos, size, digest)."""
    dealt = _in_ranges(nodes, span)
    # A range's message has the least position, so it arrives before the nodes.
    first = messages.withColumn("pos", F.lit(-1).cast("long"))
    dealt = dealt.unionByName(first, allowMissingColumns=True)

    def work(rows: list[tuple]) -> list[tuple]:
        subroot, above = rows[0][-2:]
        steps = levels_above(rows[1][3], span)
        proofs = backward(forward([r[4] for r in rows[1:]], steps), steps, above)
        return [told(r[:-2], subroot, p) for r, p in zip(rows[1:], proofs, strict=True)]

    return _per_range(dealt, work, schema)


def delivered(of: list[DataFrame], tops: DataFrame, span: int) -> DataFrame:
    """The messages (``MESSAGE``) to the ranges of the lowest tier.

    ``tops`` has (tree, subroot, proof) of each tree.
    """
    messages = tops.select("tree", F.lit(0).cast("long").alias("range"), "subroot", "proof")
    for nodes in reversed(of[1:-1]):
        told = lambda row, subroot, proof: (row[0], row[2], subroot, proof)
        messages = keep(_swept(nodes, messages, span, MESSAGE, told))
    return messages


def placed(rows: DataFrame, tree: Column) -> DataFrame:
    """``rows``, ranked by ``at``, with their ``tree``, place in it and its size.

    ``at`` is the task and the place in it; a tree's rows in one task follow each
    other, so one start for each (tree, task) gives all places.
    """
    rows = rows.withColumn("tree", tree).withColumn("part", F.shiftrightunsigned("at", 33))
    starts = rows.groupBy(F.col("tree").alias("t"), F.col("part").alias("p")).agg(
        F.min("at").alias("first"), F.count("*").alias("n")
    )
    before = Window.partitionBy("t").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(
        "t",
        "p",
        (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("shift"),
        F.sum("n").over(Window.partitionBy("t")).alias("size"),
    )
    on = F.col("tree").eqNullSafe(F.col("t")) & (F.col("part") == F.col("p"))
    joined = rows.join(small_side(keep(starts)), on)
    return joined.withColumn("pos", F.col("at") - F.col("shift")).drop("t", "p", "shift", "part", "at")


def merkle_manifest(leaves: DataFrame, span: int = SPAN) -> DataFrame:
    """The manifest of ``leaves(doc_id, source, leaf, ...)``, which has all their columns
    and subroot, root, pos (place in the source) and proof.

    ``proof`` has a run for each level, from the leaf's to the root's: the digests of
    the run's others from left to right, and the node's own place among them.
    """
    spark = leaves.sparkSession
    extra = [c for c in leaves.columns if c not in ("doc_id", "source", "leaf")]
    columns = ["doc_id", "source", *extra]
    # Equal rows are told apart by a row number, so they spread over tasks.
    numbered = keep(leaves.withColumn("_row", F.monotonically_increasing_id()))
    ordered = ranked(numbered, ["source", "doc_id", "leaf", "_row"], "at").drop("_row")
    nodes = placed(ordered, F.col("source")).withColumnRenamed("leaf", "digest")
    nodes = nodes.select(*NODE, *columns)
    by_source = tiers(nodes, span)
    subroots = by_source[-1].filter("size = 1").select(F.col("tree").alias("source"), "digest")
    top = placed(ranked(subroots, ["source"], "at"), F.lit(None).cast("string")).select(*NODE, "source")
    whole = tiers(top, span)
    roots = whole[-1].select("digest").take(1)
    root = roots[0].digest if roots else None

    start = spark.createDataFrame([(None, None, [])], f"tree string, subroot string, proof array<{RUN}>")
    start = start if root else start.limit(0)
    told = lambda row, _, proof: (row[5], row[4], proof)
    tops = f"tree string, subroot string, proof array<{RUN}>"
    tops = keep(_swept(top, delivered(whole, start, span), span, tops, told))

    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    schema += f", leaf string, subroot string, pos long, proof array<{RUN}>"
    told = lambda row, subroot, proof: (*row[5:], row[4], subroot, row[2], proof)
    proved = _swept(nodes, delivered(by_source, tops, span), span, schema, told)
    return proved.withColumn("root", F.lit(root).cast("string"))


def proof_text(proof: str | Column) -> Column:
    """All digests of a proof, level by level and from left to right."""
    return F.array_join(F.flatten(F.transform(proof, lambda run: run.others)), "")


def folded(leaf: str | Column, proof: str | Column) -> Column:
    """The root that a leaf's digest and a proof lead to."""
    leaf = F.col(leaf) if isinstance(leaf, str) else leaf

    def up(value: Column, run: Column) -> Column:
        left = F.array_join(F.slice(run.others, F.lit(1), run.place), "")
        right = F.array_join(F.slice(run.others, run.place + 1, F.size(run.others)), "")
        return F.sha2(F.concat(left, value, right), 256)

    return F.aggregate(proof, leaf, up)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    fields = {c: F.col(c) for c in FIELDS}
    cut = F.replace("text", F.lit("\n"), F.lit(""))
    tampered = F.when(crc_of_id(2) == 0, leaf_digest({**fields, "text": cut}))
    leaves = docs.select("doc_id", "source", leaf_digest(fields).alias("leaf"), tampered.alias("tampered"))
    rows = merkle_manifest(leaves).withColumn(
        "folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    )
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


SQL = """
WITH RECURSIVE
fields AS (
  SELECT doc_id, source,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
    || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    text, replace(text, chr(10), '') AS cut,
    list_reduce(list_concat([4294967295::UBIGINT],
      flatten([[((ord(c)::UBIGINT >> i) & 1)::UBIGINT FOR i IN range(8)]
        FOR c IN string_split(doc_id::VARCHAR, '')])),
      lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1
        THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN xor(crc, 1) & 1 = 0 THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) END AS tampered
  FROM fields),
leaves AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS id,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM hashed),
low(tree, lvl, pos, d, n) AS (
  SELECT tree, 0, pos, leaf, n FROM leaves
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3
  FROM low WHERE n > 1 GROUP BY tree, lvl, pos // 3, n),
high(lvl, pos, d, n) AS (
  SELECT 0, tree, d, count(*) OVER () FROM low WHERE n = 1
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3
  FROM high WHERE n > 1 GROUP BY lvl, pos // 3, n),
nodes AS (
  SELECT tree, lvl, pos, d FROM low UNION ALL SELECT -1, lvl, pos, d FROM high),
path(id, step, tree, lvl, pos, n, d, sent) AS (
  SELECT id, 0, tree, 0, pos, n, coalesce(tampered, leaf), '' FROM leaves
  UNION ALL
  SELECT p.id, p.step + 1,
    CASE WHEN p.n > 1 THEN p.tree ELSE -1 END,
    CASE WHEN p.n > 1 THEN p.lvl + 1 ELSE 0 END,
    CASE WHEN p.n > 1 THEN p.pos // 3 ELSE p.tree END,
    CASE WHEN p.n > 1 THEN (p.n + 2) // 3 ELSE (SELECT count(*) FROM low WHERE n = 1) END,
    CASE WHEN p.n > 1 THEN sha256(string_agg(CASE WHEN s.pos = p.pos THEN p.d ELSE s.d END, '' ORDER BY s.pos))
      ELSE p.d END,
    CASE WHEN p.n > 1 THEN coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (s.pos <> p.pos), '') ELSE '' END
  FROM path p LEFT JOIN nodes s
    ON p.n > 1 AND s.tree = p.tree AND s.lvl = p.lvl AND s.pos // 3 = p.pos // 3
  WHERE p.n > 1 OR p.tree >= 0
  GROUP BY p.id, p.step, p.tree, p.lvl, p.pos, p.n, p.d),
proofs AS (
  SELECT id, sha256(string_agg(sent, '' ORDER BY step)) AS proof_sha256, arg_max(d, step) AS folded_root
  FROM path GROUP BY id)
SELECT l.doc_id, l.leaf, s.d AS subroot, r.d AS root, p.proof_sha256, p.folded_root,
  p.folded_root = r.d AS verified
FROM leaves l JOIN proofs p ON p.id = l.id
JOIN low s ON s.tree = l.tree AND s.n = 1
JOIN high r ON r.n = 1
"""
