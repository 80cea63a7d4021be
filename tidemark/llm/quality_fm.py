"""Text quality with a factorisation machine.

Features of a text are its hashed distinct words, statistics of its structure
and metadata (its recorded length against the real one). The score is the
logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

so all pairwise interactions cost time linear in the features. Learning uses at
most ``sample_rows`` labelled rows (chosen by a hash of their id, the
classifier's documented bound) and AdaGrad steps of the logistic loss; it is
deterministic. Every text gets a score, empty ones and NULL too.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import crc_of_id, forget, table, worker_memory

WORD_SLOTS = 1 << 15
RANK = 8
SAMPLE_ROWS = 6_000
EPOCHS = 6
BATCH = 128
STEP = 0.08
PENALTY = 1e-4
THRESHOLD = 0.3
#: Words a worker remembers the slot of.
REMEMBERED = 300_000

SYMBOLS = "!?$#%*&|<>=+@~^_/\\"
STATISTICS = (
    ["words", "letters", "upper", "digits", "spaces", "other", "lines", "word length"]
    + ["distinct words", "distinct lines", "short lines", "line length", "all upper words"]
    + ["ends with symbol", "longest word", "length known", "length ratio"]
    + [f"symbol {s}" for s in SYMBOLS]
)


class _WordSlots(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        slot = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_SLOTS
        return slot


def statistics(text: str, n_chars: float | None) -> list[float]:
    """The values of ``STATISTICS``, each of a bounded size."""
    n = max(len(text), 1)
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    seen = np.bincount(data, minlength=256)
    upper, lower = seen[65:91].sum(), seen[97:123].sum() + seen[128:].sum()
    digits, spaces = seen[48:58].sum(), seen[[9, 10, 11, 12, 13, 32]].sum()
    size = max(len(data), 1)
    count = max(len(words), 1)
    distinct = set(words)
    capitals = sum(map(str.isupper, words)) if upper * 4 > lower else 0
    known = n_chars is not None and n_chars == n_chars
    ends = 0
    if sum(seen[ord(s)] for s in SYMBOLS) * 4 > count:
        ends = sum(w[-1] in SYMBOLS for w in words)
    return [
        np.log1p(len(words)) / 8,
        (upper + lower) / size,
        upper / size * 4,
        digits / size * 4,
        spaces / size,
        (size - upper - lower - digits - spaces) / size * 4,
        np.log1p(len(lines)) / 5,
        min(n / count, 40) / 10,
        len(distinct) / count,
        len(set(lines)) / max(len(lines), 1),
        sum(len(line) < 30 for line in lines) / max(len(lines), 1),
        np.log1p(n / max(len(lines), 1)) / 8,
        capitals / count,
        ends / count,
        min(max(map(len, words), default=0), 100) / 50,
        float(known),
        min(n_chars / n, 3.0) / 3 if known else 0.0,
        *[min(seen[ord(s)] / count, 2.0) for s in SYMBOLS],
    ]


def features(text: str | None, n_chars: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text's features; words first, then statistics."""
    text = text or ""
    slot_of = worker_memory("word slots", _WordSlots).__getitem__
    slots = np.array(sorted(set(map(slot_of, set(text.lower().split())))), dtype=np.int64)
    values = np.full(len(slots), 1 / np.sqrt(max(len(slots), 1)))
    own = np.arange(WORD_SLOTS, WORD_SLOTS + len(STATISTICS))
    return np.concatenate([slots, own]), np.concatenate([values, statistics(text, n_chars)])


@dataclass
class FactorisationMachine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def _scaled(self, values: np.ndarray) -> np.ndarray:
        values = values.copy()
        at = len(values) - len(STATISTICS)
        values[at:] = np.clip((values[at:] - self.centre) / self.scale, -4, 4) * 0.3
        return values

    def score(self, slots: np.ndarray, values: np.ndarray) -> float:
        x = self._scaled(values)
        vx = self.factors[slots] * x[:, None]
        pairs = 0.5 * (vx.sum(axis=0) ** 2 - (vx**2).sum(axis=0)).sum()
        z = self.bias + self.weights[slots] @ x + pairs
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> FactorisationMachine:
    """Fit (label, slots, values) rows."""
    size = WORD_SLOTS + len(STATISTICS)
    rng = np.random.default_rng(7)
    stats = np.array([v[-len(STATISTICS) :] for _, _, v in rows]).reshape(-1, len(STATISTICS))
    centre = stats.mean(axis=0) if len(rows) else np.zeros(len(STATISTICS))
    scale = stats.std(axis=0) + 1e-3 if len(rows) else np.ones(len(STATISTICS))
    share = np.mean([y for y, _, _ in rows]) if rows else 0.5
    share = float(np.clip(share, 0.01, 0.99))
    fm = FactorisationMachine(
        float(np.log(share / (1 - share))),
        np.zeros(size),
        rng.normal(0, 0.05, (size, RANK)),
        centre,
        scale,
    )
    rows = [(y, s, fm._scaled(v)) for y, s, v in rows]
    w_sum, v_sum = np.full(size, 1e-2), np.full((size, RANK), 1e-2)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), BATCH):
            batch = [rows[i] for i in order[start : start + BATCH]]
            slots = np.concatenate([s for _, s, _ in batch])
            x = np.concatenate([v for _, _, v in batch])
            lengths = np.array([len(s) for _, s, _ in batch])
            begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            v = fm.factors[slots]
            vx = v * x[:, None]
            sums = np.add.reduceat(vx, begins)
            squares = np.add.reduceat(vx**2, begins)
            linear = np.add.reduceat(fm.weights[slots] * x, begins)
            z = fm.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1)
            y = np.array([label for label, _, _ in batch])
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(batch)
            each = np.repeat(error, lengths)
            touched, where = np.unique(slots, return_inverse=True)
            w_grad = np.bincount(where, each * x) + PENALTY * fm.weights[touched] / 10
            v_rows = each[:, None] * x[:, None] * (np.repeat(sums, lengths, axis=0) - vx)
            v_grad = np.stack([np.bincount(where, v_rows[:, f]) for f in range(RANK)], axis=1)
            v_grad += PENALTY * fm.factors[touched]
            w_sum[touched] += w_grad**2
            v_sum[touched] += v_grad**2
            fm.weights[touched] -= STEP * w_grad / np.sqrt(w_sum[touched])
            fm.factors[touched] -= STEP * v_grad / np.sqrt(v_sum[touched])
            fm.bias -= STEP * error.sum()
    return fm


def learn_quality(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> FactorisationMachine:
    """Learn from ``labelled(doc_id, text, n_chars, quality)``, at most a sample."""

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [features(t, c) for t, c in zip(frame["text"], frame["n_chars"], strict=True)]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "quality": frame["quality"],
                    "slots": [s.astype(np.int32) for s, _ in found],
                    "stats": [v[-len(STATISTICS) :] for _, v in found],
                }
            )

    labelled = labelled.select("doc_id", "text", "n_chars", "quality")
    # An id may stand for any number of rows: thinned before anything is collected.
    rows, most = labelled.count(), 2 * sample_rows
    if rows > most:
        row = F.xxhash64("doc_id", F.monotonically_increasing_id())
        labelled = labelled.filter(F.pmod(row, F.lit(1_000_000)) < int(1_000_000 * most / rows))
    shape = "doc_id long, quality int, slots array<int>, stats array<double>"
    seen = labelled.mapInPandas(extract, shape).toPandas()
    seen = seen.sort_values(["doc_id", "quality"], kind="stable").head(2 * sample_rows)
    rows = []
    for label, slots, stats in zip(seen["quality"], seen["slots"], seen["stats"], strict=True):
        words = len(slots) - len(STATISTICS)
        values = np.concatenate([np.full(words, 1 / np.sqrt(max(words, 1))), stats])
        rows.append((int(label), np.asarray(slots, np.int64), values))
    return calibrated(rows)


def calibrated(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> FactorisationMachine:
    """A machine whose scores part the labels at ``THRESHOLD``.

    Every fourth row is kept out of the fit. The cut that parts those best, each label
    counting alike, is moved to the threshold by the bias, which changes no order of
    scores. Without rows of both labels the bias stays.
    """
    fm = fit([r for i, r in enumerate(rows) if i % 4])
    apart = [(y, logit(fm.score(s, v))) for y, s, v in rows[::4]]
    good, bad = ([z for y, z in apart if y == label] for label in (1, 0))
    if good and bad:
        fm.bias += logit(THRESHOLD) - best_cut(good, bad)
    return fm


def logit(p: float) -> float:
    p = min(max(p, 1e-12), 1 - 1e-12)
    return math.log(p / (1 - p))


def best_cut(good: list[float], bad: list[float]) -> float:
    """The middle of the widest gap among the cuts with the most of both labels right."""
    values = sorted({*good, *bad})
    ends = [values[0] - 1, *values, values[-1] + 1]
    found = []
    for low, high in zip(ends, ends[1:], strict=False):
        cut = (low + high) / 2
        right = sum(z >= cut for z in good) / len(good) + sum(z < cut for z in bad) / len(bad)
        found.append((right, high - low, cut))
    return max(found)[2]


def training_rows(
    documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Documents with a label, but those kept back; about ``sample_rows`` at most.

    The labels are thinned by a hash of the id before they meet the texts, so a
    broadcast of them is bounded by the sample. An id with several labels takes
    the majority, 1 on a tie.
    """
    known = labels.filter("quality IS NOT NULL").filter(crc_of_id(5) != 0)
    known = known.groupBy("doc_id").agg(F.avg("quality").alias("_mean"))
    rows = known.count()
    if rows > sample_rows:
        place = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1_000_000))
        known = known.filter(place < int(1_000_000 * sample_rows / rows))
    known = known.select("doc_id", (F.col("_mean") >= 0.5).cast("int").alias("quality"))
    return documents.select("doc_id", "text", "n_chars").join(F.broadcast(known), "doc_id")


def scorer(spark: SparkSession, model: FactorisationMachine, forgetful: bool = False):
    """A column function: (text, n_chars) -> score.

    ``forgetful`` workers give back what they hold after each task.
    """
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        fm = sent.value
        for texts, lengths in parts:
            yield pd.Series(
                [fm.score(*features(t, c)) for t, c in zip(texts, lengths, strict=True)], dtype="float64"
            )
        if forgetful:
            forget()

    return score


def keep_good(
    docs: DataFrame, model: FactorisationMachine, threshold: float = THRESHOLD, forgetful: bool = False
) -> DataFrame:
    """``docs`` without texts scored below the threshold."""
    score = scorer(docs.sparkSession, model, forgetful)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"))
    marked = rows.withColumn("_score", score(F.col("_row.text"), F.col("_row.n_chars").cast("double")))
    return marked.filter(F.col("_score") >= threshold).select("_row.*")


def op6_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = learn_quality(training_rows(documents, table(spark, sf_dir, "labels")))
    score = scorer(spark, model)
    scored = documents.select("doc_id", score("text", F.col("n_chars").cast("double")).alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(crc_of_id(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
