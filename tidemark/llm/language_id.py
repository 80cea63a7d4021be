"""Language identification with language-bitmask n-gram filters.

One bit-sliced Bloom filter holds all languages: a row of it is a bitmask with a
bit per language, and looking an n-gram up is the AND of its ``HASHES`` rows,
which returns every language containing it at once. A text's n-grams are looked
up, set bits are counted per language, and the counts are corrected for false
positives: of ``n`` n-grams ``n * fill^HASHES`` hit by chance. The language with
the largest corrected count is predicted.

Learning counts n-grams per language over at most ``sample_rows`` labelled rows
(chosen by a hash of their id, the classifier's documented bound). An n-gram
belongs to a language if it occurs there at ``SHARE`` of its highest rate in any
language. The filter has a fixed number of rows, whatever the sample.

Texts are lower-cased; all but letters counts as one space; n-grams have three
and four characters and no inner space. NULL texts and texts without a letter
are ``und`` with score 0, as is every text if nothing could be learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import batches, crc_of_id, forget, table, whole_text, worker_memory

SIZES = (3, 4)
HASHES = 3
FILTER_BITS = 20
SHARE = 0.4
LEAST_COUNT = 2
SAMPLE_ROWS = 20_000
#: N-grams after which a text's confidence no longer rises.
ENOUGH = 60
UNDETERMINED = "und"
#: Languages a 64-bit row holds; more take further filters.
SLICE = 62

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def gram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the n-grams of all texts, and how many each text has."""
    codes = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
    chars = np.concatenate([np.zeros(0, np.uint32), *codes])
    chars = np.where(_letter_table()[chars], chars, np.uint32(32))
    space = chars == 32
    keep = np.ones(len(chars), bool)
    keep[1:] = ~(space[1:] & space[:-1] & (owner[1:] == owner[:-1]))
    chars, space, owner = chars[keep].astype(np.uint64), space[keep], owner[keep]
    found, owners = [], []
    for size in SIZES:
        n = len(chars) - size + 1
        if n <= 0:
            continue
        mixed = np.full(n, size, np.uint64)
        for i in range(size):
            mixed = (mixed ^ chars[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        whole = owner[:n] == owner[size - 1 :]
        for i in range(1, size - 1):
            whole &= ~space[i : i + n]
        found.append(mixed[whole])
        owners.append(owner[:n][whole])
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    hashes, owners = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return hashes[order], np.bincount(owners, minlength=len(texts))


def _rows_of(hashes: np.ndarray) -> list[np.ndarray]:
    """The filter rows of each hash, by double hashing."""
    first = hashes >> np.uint64(64 - FILTER_BITS)
    step = (hashes >> np.uint64(20)) | np.uint64(1)
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return [((first + np.uint64(i) * step) & mask).astype(np.int64) for i in range(HASHES)]


@dataclass
class LanguageModel:
    languages: list[str]
    filters: list[np.ndarray]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language and the score of each text."""
        hashes, sizes = gram_hashes([t or "" for t in texts])
        if not self.languages or not len(hashes):
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        rows = _rows_of(hashes)
        ends = np.cumsum(sizes)
        counts = np.zeros((len(texts), len(self.languages)))
        for number, bits in enumerate(self.filters):
            masks = bits[rows[0]]
            for row in rows[1:]:
                masks &= bits[row]
            for i in range(min(SLICE, len(self.languages) - number * SLICE)):
                bit = bits.dtype.type(1 << i)
                hits = np.concatenate([[0], np.cumsum((masks & bit) != 0)])
                hits = hits[ends] - hits[ends - sizes]
                chance = np.mean((bits & bit) != 0) ** HASHES
                true = (hits - sizes * chance) / max(1 - chance, 1e-9)
                counts[:, number * SLICE + i] = np.clip(true, 0, sizes)
        share = counts / np.maximum(sizes, 1)[:, None]
        best = share.argmax(axis=1)
        weight = 0.5 * np.minimum(sizes, ENOUGH)
        odds = np.exp((share - share.max(axis=1, keepdims=True)) * weight[:, None])
        score = np.where(sizes > 0, 1 / odds.sum(axis=1), 0.0)
        known = [self.languages[b] if n else UNDETERMINED for b, n in zip(best, sizes, strict=True)]
        return known, score


def learn_languages(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn from ``labelled(doc_id, text, lang)``, a bounded sample of its rows."""
    labelled = labelled.select("doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    languages = [r.lang for r in labelled.groupBy("lang").count().orderBy("lang").collect()]
    if not languages:
        return LanguageModel([], [])
    rows = labelled.count()
    if rows > sample_rows:
        place = F.pmod(F.xxhash64(F.lit("languages"), "doc_id"), F.lit(1_000_000))
        labelled = labelled.filter(place < int(1_000_000 * sample_rows / rows))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker_memory("languages", object)  # releases what other operators remember
        for frame in batches(frames):
            for lang, part in frame.groupby("lang"):
                hashes, n = np.unique(gram_hashes(part["text"].tolist())[0], return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": hashes.view(np.int64), "n": n})

    grams = labelled.mapInPandas(count, "lang string, gram long, n long")
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = {r.lang: r.total for r in grams.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
    rate = F.lit(0.0)
    for lang, total in totals.items():
        rate = F.when(F.col("lang") == lang, F.col("n") / total).otherwise(rate)
    per_gram = grams.filter(F.col("n") >= LEAST_COUNT).withColumn("rate", rate)
    per_gram = per_gram.groupBy("gram").agg(
        F.max("rate").alias("top"), F.collect_list(F.struct("lang", "rate")).alias("seen")
    )
    member = per_gram.select("gram", "top", F.inline("seen")).filter(F.col("rate") >= SHARE * F.col("top"))
    number = F.lit(0)
    for i, lang in enumerate(languages):
        number = F.when(F.col("lang") == lang, i).otherwise(number)
    member = member.select("gram", number.alias("language"))

    def slots(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            hashes = frame["gram"].to_numpy().view(np.uint64)
            language = frame["language"].to_numpy()
            for row in _rows_of(hashes):
                bits = np.left_shift(np.int64(1), (language % SLICE).astype(np.int64))
                yield pd.DataFrame({"part": language // SLICE, "slot": row, "bits": bits})

    # At most 2^FILTER_BITS rows a slice reach the driver, however much was learned.
    filled = (
        member.mapInPandas(slots, "part int, slot long, bits long")
        .groupBy("part", "slot")
        .agg(F.bit_or("bits").alias("bits"))
        .toPandas()
    )
    filters = []
    for part in range(-(-len(languages) // SLICE)):
        kind = np.uint8 if len(languages) <= 8 else np.int64
        bits = np.zeros(1 << FILTER_BITS, kind)
        own = filled[filled["part"] == part]
        bits[own["slot"].to_numpy()] = own["bits"].to_numpy().astype(kind)
        filters.append(bits)
    return LanguageModel(languages, filters)


def predictor(spark: SparkSession, model: LanguageModel, forgetful: bool = False):
    """A column function: text -> struct(lang_pred, score).

    ``forgetful`` workers give back what they hold after each task.
    """
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        worker_memory("languages", object)  # releases what other operators remember
        for part in parts:
            langs, scores = [], []
            for frame in batches([pd.DataFrame({"text": part.fillna("")})]):
                found, score = sent.value.predict(frame["text"].tolist())
                langs += found
                scores.append(score)
            yield pd.DataFrame({"lang_pred": langs, "score": np.concatenate([np.zeros(0), *scores])})
        if forgetful:
            forget()

    return predict


def identify(docs: DataFrame, model: LanguageModel, text: Column | None = None) -> DataFrame:
    """``docs`` with one more column ``language``: struct(lang_pred, score)."""
    predict = predictor(docs.sparkSession, model)
    return docs.withColumn("language", predict(F.col("text") if text is None else text))


def training_rows(documents: DataFrame) -> DataFrame:
    return documents.filter(F.coalesce(crc_of_id(4) != 2, F.lit(False)))


def keep_identified(docs: DataFrame, model: LanguageModel, forgetful: bool = False) -> DataFrame:
    """``docs`` without texts of no determined language.

    A score says how far a language leads, not whether a text is clean: it is low
    for any short text and falls with the number of languages.
    """
    predict = predictor(docs.sparkSession, model, forgetful)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"))
    marked = rows.withColumn("_language", predict(F.col("_row.text")))
    return marked.filter(F.col("_language.lang_pred") != UNDETERMINED).select("_row.*")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = learn_languages(training_rows(documents))
    found = identify(documents.select("doc_id", whole_text().alias("text")), model)
    return found.select(
        "doc_id",
        F.coalesce(crc_of_id(4) == 2, F.lit(False)).alias("held_out"),
        "language.lang_pred",
        "language.score",
    )
