"""Benchmark items inside long documents: size-partitioned MinHash containment search, verified by exact shingles.

Items are partitioned by the size of their shingle set; partition ``s`` holds sizes above s / 2 and up to s. For each
partition a document is cut into blocks of s shingles, so that both sides of a comparison are of like size however
long the document is. A block's minimum under each of ``PERMUTATIONS`` permutations is looked up among the items'
minima. Under one permutation, an item of which four fifths lie in the document, in one place or in many, is met with
probability 0.8 * (s/2) / (s/2 + s) at least, so that one is missed with 0.734**64, about 2e-9.

A pair met is verified on the shingles themselves, of the whole document and the whole item. Documents are mapped
where they lie, without a shuffle. Items are told to all tasks in slices of bounded size, one pass a slice.

Null and empty texts hold nothing and are held by nothing. A text of fewer than ``k`` words has one shingle of them
all, and so meets texts of the very same words only. Repeated rows give repeated pairs. Empty tables give no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

WORDS, PERCENT, PERMUTATIONS = 5, 80, 64
#: Bounds of a slice of items: rows, and characters of text.
SLICE_ITEMS, SLICE_CHARS = 20_000, 16_000_000
_FACTORS = np.random.default_rng(20_250).integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SIEVE_BITS = 20


def plain_shingles(text: str, k: int) -> set[bytes]:
    """The shingles themselves, as bytes."""
    words = [w for w in text.encode().lower().translate(_ONE_SPACE).split(b" ") if w]
    return {b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


_ONE_SPACE = bytes(32 if tokens.WHITE[c] else c for c in range(256))


@dataclass
class Index:
    """Items of one slice: their minima in order, with partition, permutation and number, and the items' own shingles."""

    keys: np.ndarray
    part: np.ndarray
    permutation: np.ndarray
    item: np.ndarray
    sieve: np.ndarray
    parts: list[int]
    ids: list
    hashes: list[np.ndarray]
    shingles: list[set[bytes]]

    @classmethod
    def of(cls, ids: list, texts: list[str | None], k: int) -> Index:
        found = list(tokens.sets(pa.array([t or "" for t in texts], pa.string()), k))
        keep = [i for i, x in enumerate(found) if len(x)]
        rows = [(h * _FACTORS[p]).min() for h in (found[i] for i in keep) for p in range(PERMUTATIONS)]
        size = [1 << int(len(found[i]) - 1).bit_length() for i in keep]
        keys = np.array(rows, np.uint64)
        order = np.argsort(keys, kind="stable")
        sieve = np.zeros(1 << _SIEVE_BITS, bool)
        sieve[keys & np.uint64((1 << _SIEVE_BITS) - 1)] = True
        return cls(
            keys[order], np.repeat(size, PERMUTATIONS)[order], np.tile(np.arange(PERMUTATIONS), len(keep))[order], np.repeat(np.arange(len(keep)), PERMUTATIONS)[order],
            sieve, sorted(set(size)), [ids[i] for i in keep], [found[i] for i in keep], [plain_shingles(texts[i], k) for i in keep],
        )

    def met(self, rows: np.ndarray, hashes: np.ndarray) -> set[tuple[int, int]]:
        """(row, item) for rows with a block whose minimum is an item's, in the item's partition."""
        out: set[tuple[int, int]] = set()
        if not len(hashes):
            return out
        first = np.searchsorted(rows, rows)
        place = np.arange(len(rows)) - first
        starts = {s: np.flatnonzero(place % s == 0) for s in self.parts}
        mask = np.uint64((1 << _SIEVE_BITS) - 1)
        for p in range(PERMUTATIONS):
            value = hashes * _FACTORS[p]
            for s, at in starts.items():
                least = np.minimum.reduceat(value, at)
                some = np.flatnonzero(self.sieve[least & mask])
                if len(some):
                    low, high = (np.searchsorted(self.keys, least[some], side) for side in ("left", "right"))
                    for i, a, b in zip(some, low, high, strict=True):
                        out.update((int(rows[at[i]]), int(self.item[j])) for j in range(a, b) if self.part[j] == s and self.permutation[j] == p)
        return out

    def held(self, texts: pa.Array, k: int, percent: int) -> Iterator[tuple[int, int, int]]:
        """(row, item, shingles shared) for the items that rows of a batch contain."""
        for first, starts, data in tokens.slices(texts):
            rows, hashes = tokens.words(starts, data)
            at, of = tokens.grams(rows, hashes, tuple(range(k)))
            short = np.flatnonzero(np.diff(np.searchsorted(rows, np.arange(len(starts)))) < k)
            if len(short):
                extra = [(i, x) for i in short for x in tokens.shingles(starts[i : i + 2] - starts[i], data[starts[i] : starts[i + 1]], k) if len(x)]
                at = np.concatenate((at, np.array([i for i, _ in extra], np.int64)))
                of = np.concatenate((of, *[x for _, x in extra])) if extra else of
                order = np.argsort(at, kind="stable")
                at, of = at[order], of[order]
            own: tuple[int, set[bytes]] | None = None
            for row, item in sorted(self.met(at, of)):
                a, b = np.searchsorted(at, (row, row + 1))
                shared = np.isin(self.hashes[item], of[a:b]).sum()
                if 100 * shared < percent * len(self.hashes[item]):
                    continue
                if own is None or own[0] != row:
                    own = (row, plain_shingles(texts[first + row].as_py(), k))
                shared = len(own[1] & self.shingles[item])
                if 100 * shared >= percent * len(self.shingles[item]):
                    yield first + row, item, shared


def slices(items: DataFrame) -> list[DataFrame]:
    """Parts of ``items`` that stay within the bounds of a slice, give or take the luck of a hash."""
    rows, chars = items.agg(F.count("*"), F.sum(F.length("text"))).first()
    count = max(1, -(-rows * 2 // SLICE_ITEMS) if rows > SLICE_ITEMS else 1, -(-(chars or 0) * 2 // SLICE_CHARS) if (chars or 0) > SLICE_CHARS else 1)
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i) for i in range(count)] if count > 1 else [items]


def _indexes(items: DataFrame, k: int) -> Iterator:
    for part in slices(items.select("item_id", "text")):
        rows = part.orderBy("item_id", "text").collect()
        yield items.sparkSession.sparkContext.broadcast(vars(Index.of([r[0] for r in rows], [r[1] for r in rows], k)))


def contained(docs: DataFrame, items: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) for items of which ``percent`` of the shingles are in a document."""
    out = None
    for told in _indexes(items, k):

        def work(batches: Iterator[pa.RecordBatch], told=told) -> Iterator[dict]:
            index = Index(**told.value)
            for batch in batches:
                found = list(index.held(common.as_text(batch.column("text")), k, percent))
                n = [len(index.shingles[i]) for _, i, _ in found]
                yield {
                    "doc_id": batch.column("doc_id").take(pa.array([r for r, _, _ in found], pa.int64())), "item_id": [index.ids[i] for _, i, _ in found],
                    "n_shared": [s for _, _, s in found], "n_item": n, "containment": [s / m for (_, _, s), m in zip(found, n, strict=True)],
                }

        got = common.over_batches(docs.select("doc_id", "text"), "doc_id long, item_id long, n_shared long, n_item long, containment double", work)
        out = got if out is None else out.union(got)
    return out


def clean(docs: DataFrame, items: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents that contain no item, with all their columns, filtered where they lie."""
    for told in _indexes(items, k):

        def work(batches: Iterator[pa.RecordBatch], told=told) -> Iterator[pa.RecordBatch]:
            index = Index(**told.value)
            for batch in batches:
                mask = np.ones(batch.num_rows, bool)
                for row, _, _ in index.held(common.as_text(batch.column("text")), k, percent):
                    mask[row] = False
                yield common.passing(batch, mask)
            common.give_back()

        common.small_batches(docs.sparkSession)
        docs = docs.mapInArrow(work, docs.schema)
    return docs


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a benchmark item."""
    return clean(docs, common.table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH w AS (
  SELECT kind, id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark)
), s AS (
  SELECT kind, id, CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) END AS sh
  FROM w
), t AS (SELECT kind, id, len(sh) AS n, unnest(sh) AS g FROM s)
SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared, b.n AS n_item, count(*) / b.n AS containment
FROM t d JOIN t b ON d.g = b.g AND d.kind = 'd' AND b.kind = 'b'
GROUP BY d.id, b.id, b.n HAVING 100 * count(*) >= 80 * b.n
"""
