"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are 64-bit hashes of words, word pairs and pairs one word apart, each once a text. Every coordinate has its
own learning rate, and the L1 term leaves few weights other than 0; those are told to all tasks. The model is fitted
in one task on a sample of bounded size; scoring maps every whole text where it lies, without a shuffle.

Labels are learned only where crc32(doc_id as text) mod 3 isn't 1. Null labels and ids are not learned; of several
labels of one id the toxic one counts. Null and empty texts score what the intercept alone gives. Without labels all
scores are 0.5. Repeated rows are repeated in the result. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

#: Bound of the sample that is fitted: toxic and other documents, about.
TOXIC_ROWS, OTHER_ROWS = 4_000, 8_000
#: Bound of the sample's text in bytes; whole texts are taken in an order by hash while they fit, larger ones are passed over.
SAMPLE_BYTES = 64 << 20
#: A feature of fewer sampled texts is not learned.
LEAST_TEXTS = 4
ALPHA, BETA, L2, EPOCHS = 3.0, 1.0, 0.001, 5
#: The L1 term: larger for more toxic texts, up to a bound.
L1_LEAST, L1_PER_TEXT, L1_MOST = 1.0, 1 / 150, 10.0
THRESHOLD = 0.7
GRAMS = ((0,), (0, 1), (0, 2))
_SKETCH = np.uint64((1 << 22) - 1)


def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, row, hash) of all grams for runs of rows, repeats included."""
    for first, starts, data in tokens.slices(texts):
        rows, hashes = tokens.words(starts, data, tokens.LETTERS)
        parts = [tokens.grams(rows, hashes, offsets) for offsets in GRAMS]
        yield first, np.concatenate([r for r, _ in parts]), np.concatenate([h for _, h in parts])


def _each(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct features of each row."""
    for i in range(len(texts)):
        got = [h for _, _, h in features(texts.slice(i, 1))]
        yield np.unique(np.concatenate(got)) if got else np.zeros(0, np.uint64)


def fit(texts: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature hashes in order, weights) other than 0; the intercept is feature 0."""
    seen = np.zeros(int(_SKETCH) + 1, np.uint8)
    for found in _each(texts):
        at = np.unique((found & _SKETCH).astype(np.int64))
        seen[at] += seen[at] < LEAST_TEXTS
    kept = [f[seen[(f & _SKETCH).astype(np.int64)] >= LEAST_TEXTS] for f in _each(texts)]
    names = np.unique(np.concatenate([*kept, np.zeros(1, np.uint64)]))
    rows = [np.concatenate(([0], np.searchsorted(names, f))) for f in kept]
    z, n = np.zeros(len(names)), np.zeros(len(names))
    l1 = min(L1_MOST, L1_LEAST + L1_PER_TEXT * (labels > 0).sum())

    def weights(at: np.ndarray) -> np.ndarray:
        over = np.abs(z[at]) - l1
        return np.where(over > 0, -np.sign(z[at]) * over / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            at = rows[i]
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[i]
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - rate * w
            n[at] += g * g
    w = weights(np.arange(len(names)))
    return names[w != 0], w[w != 0]


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def model(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Fit on a sample of the labelled documents, in one task, and fetch the few weights."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r[0]: r[1] for r in known.groupBy((F.col("toxic") > 0).alias("toxic")).count().collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30))
    share = F.when(F.col("toxic") > 0, F.lit(TOXIC_ROWS / max(1, counts.get(True, 0)))).otherwise(F.lit(OTHER_ROWS / max(1, counts.get(False, 0))))
    some = known.where(place < share * (1 << 30)).select(F.col("doc_id").alias("__id"), (F.col("toxic") > 0).alias("__toxic"))
    # the sample's size is a parameter, so that it can be told to all tasks
    sample = docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("__id")).select("doc_id", "text", F.col("__toxic").cast("int").alias("toxic"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, room = [], SAMPLE_BYTES
        for batch in common.parts(batches):
            size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            take = []
            for n in size:
                take.append(n <= room)
                room -= n * take[-1]
            if any(take):
                held.append(common.passing(batch, np.array(take)))
        if not held:
            return
        got = pa.Table.from_batches(held)
        got = got.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
        texts = got.column("text").combine_chunks()
        names, w = fit(common.as_text(texts), got.column("toxic").to_numpy())
        yield {"name": tokens.signed(names), "weight": w}

    # in an order that is fixed: of equal hashes the text decides
    dealt = sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id", F.lit(12)), "doc_id", "text")
    rows = common.over_batches(dealt, "name long, weight double", work).toPandas()
    names = rows["name"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(names)
    return names[order], rows["weight"].to_numpy(np.float64)[order]


class Scorer:
    def __init__(self, names: np.ndarray, weights: np.ndarray) -> None:
        self.names, self.weights = names, weights
        self.start = float(weights[0]) if len(names) and names[0] == 0 else 0.0
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(names & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def scores(self, texts: pa.Array) -> np.ndarray:
        total = np.full(len(texts), self.start)
        for first, rows, hashes in features(texts):
            some = self.sieve[hashes & np.uint64((1 << 20) - 1)]
            rows, hashes = rows[some], hashes[some]
            if not len(hashes):
                continue
            at = np.minimum(np.searchsorted(self.names, hashes), len(self.names) - 1)
            hit = self.names[at] == hashes
            pairs = np.unique(np.stack([rows[hit], at[hit]]), axis=1)
            np.add.at(total, first + pairs[0], self.weights[pairs[1]])
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs(doc_id, text)``."""
    told = docs.sparkSession.sparkContext.broadcast(model(docs, labels))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        scorer = Scorer(*told.value)
        for batch in batches:
            score = scorer.scores(common.as_text(batch.column("text")))
            yield {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": score, "predicted": (score >= THRESHOLD).astype(np.int32)}

    return common.over_batches(docs.select("doc_id", held_out().alias("held_out"), "text"), "doc_id long, held_out boolean, score double, predicted int", work)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't predicted toxic, filtered where they lie."""
    told = spark.sparkContext.broadcast(model(docs, common.table(spark, sf_dir, "labels")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*told.value)
        for batch in batches:
            yield common.passing(batch, scorer.scores(common.as_text(batch.column("text"))) < THRESHOLD)

    return docs.mapInArrow(work, docs.schema)
