"""Repeated byte strings by blockwise suffix sorting with a difference cover.

Wanted is every byte that lies in a string of ``LENGTH`` bytes which also starts earlier (in a document before, or
earlier in the same one). Suffixes need to be told apart by their first ``LENGTH`` bytes only.

1. Documents are packed into blocks of some megabytes, which are written once, bucketed by block, so that what later
   steps learn about a block meets it without moving texts again. Whole copies of an earlier document go first: all
   of their strings start earlier, and none of them is needed as a source.
2. *Cover sample.* The offsets ``D`` modulo ``V`` are a difference cover: for any two places i and j there is a shift
   below ``V`` that brings both to sampled places. Equal strings of ``LENGTH`` bytes at i and j thus hold equal strings of
   ``LENGTH - V + 1`` bytes at a pair of sampled places. Those are ranked bucket by bucket; all that a suffix needs to
   know of its samples is whether their rank is shared. A suffix with no shared rank among its first ``V`` places ties
   with no other and is done.
3. *Suffix buckets.* The other suffixes are dealt to buckets; each bucket is sorted by itself, at most about
   ``BUCKET`` suffixes at once, and of equal ones the first in the order of documents stays. The answers go back to the
   blocks as one bit a suffix, in the order in which the block has sent them.

Strings are ranked and sorted by fingerprints of their bytes, not by the bytes: any order serves to bring equal
ones together. 32 bits within a bucket are enough for the sample (a false tie costs work only); suffixes are told apart by
56 bits besides those of their bucket. Within a block equal strings are one before they are sent, so that a string that
makes up a third of a corpus is as many rows as there are blocks.

Documents are ordered by doc_id, null ids last; rows of one id in the order in which the table is read. Null texts are empty;
texts of fewer than ``LENGTH`` bytes lose nothing. Repeated rows are copies. A text larger than a block is a block of its
own, looked at piece by piece. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

LENGTH = 100
# A perfect difference cover of 6 offsets.
V, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Text bytes of a block, from small to very large corpora.
BLOCK_BYTES, MOST_BLOCK_BYTES = 8 << 20, 64 << 20
#: Suffixes of a bucket, about.
BUCKET = 1 << 20
#: Bytes looked at together.
PIECE = 1 << 19

_BLOCK = "block long, ids binary, lengths binary, bytes long, texts binary"
_NO_ID = np.iinfo(np.int64).max

_random = np.random.default_rng(77_003)
_BASES = [int(x) * 2 + 1 for x in _random.integers(1 << 62, size=2, dtype=np.uint64)]
_VALUES = _random.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


# --- blocks -------------------------------------------------------------------------------------------------


def _zipped(data: bytes | np.ndarray) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def _unzipped(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd"), np.uint8) if size else np.zeros(0, np.uint8)


def blocks(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    """(block, ids, lengths, bytes, texts) as a table bucketed by block; within a block documents are in order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[int, bytes]] = []
        total = 0

        def packed() -> dict:
            held.sort(key=lambda x: x[0])
            ids, lengths = np.array([i for i, _ in held], np.int64), np.array([len(t) for _, t in held], np.int64)
            return {"block": [number], "ids": [ids.tobytes()], "lengths": [lengths.tobytes()], "bytes": [total], "texts": [_zipped(b"".join(t for _, t in held))]}

        for batch in batches:
            ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy()
            for i, text in zip(ids, common.as_text(batch.column("text")), strict=True):
                data = text.as_buffer().to_pybytes()
                if held and total + len(data) > size:
                    yield packed()
                    number, held, total = number + 1, [], 0
                held.append((int(i), data))
                total += len(data)
        if held:
            yield packed()

    spark = docs.sparkSession
    rows = common.over_batches(docs.select(F.col("doc_id").cast("long"), "text"), _BLOCK, work)
    name = f"text_blocks_{uuid.uuid4().hex}"
    rows.write.bucketBy(buckets, "block").option("path", common.work_path(spark, "blocks")).saveAsTable(name)
    return spark.table(name)


class Block:
    """One block's bytes, with the samples and suffixes that it sends, each in a fixed order."""

    def __init__(self, ids: bytes, lengths: bytes, size: int, texts: bytes, copies: list[int], bits: int):
        self.ids, self.lengths = np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int64)
        self.ends = np.cumsum(self.lengths)
        self.data = _unzipped(texts, size)
        self.live = np.ones(len(self.ids), bool)
        self.live[copies] = False
        self.bits = bits

    def _places(self, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(begin, bytes, document, place in it) of the pieces' places at which ``length`` bytes of a live document start."""
        for begin in range(0, len(self.data), PIECE):
            end = min(begin + PIECE, len(self.data))
            first, last = np.searchsorted(self.ends, [begin, end - 1], "right")
            cuts = np.clip(self.ends[first : last + 1], begin, end)
            doc = np.repeat(np.arange(first, last + 1), np.diff(cuts, prepend=begin))
            at = np.arange(begin, end)
            ok = np.flatnonzero((self.ends[doc] - at >= length) & self.live[doc])
            if len(ok):
                doc = doc[ok]
                yield begin, self.data[begin : end + length], ok, at[ok] - (self.ends[doc] - self.lengths[doc])

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, fingerprint) of the cover's strings."""
        length = LENGTH - V + 1
        cover = np.zeros(V, bool)
        cover[list(COVER)] = True
        where, prints = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for begin, data, ok, local in self._places(length):
            at = ok[cover[local % V]]
            where.append(begin + at)
            prints.append(tokens.mix(_fingerprints(data, length, 0, at)))
        return np.concatenate(where), np.concatenate(prints)

    def suffixes(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, bucket, key) of the suffixes with a shared rank among their first ``V`` places."""
        mark = np.zeros(len(self.data) + V, np.uint8)
        mark[shared] = 1
        where, buckets, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for begin, data, ok, _ in self._places(LENGTH):
            before = np.zeros(PIECE + V + 1, np.int32)
            some = mark[begin : begin + PIECE + V]
            np.cumsum(some, out=before[1 : len(some) + 1])
            at = ok[before[ok + V] > before[ok]]
            if len(at):
                where.append(begin + at)
                keys.append(tokens.mix(_fingerprints(data, LENGTH, 0, at)) >> np.uint64(8))
                buckets.append(_top(tokens.mix(_fingerprints(data, LENGTH, 1, at)), self.bits))
        return np.concatenate(where), np.concatenate(buckets), np.concatenate(keys)


def _top(prints: np.ndarray, bits: int) -> np.ndarray:
    return (prints >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(prints), np.int64)


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if which not in _powers or len(_powers[which][0]) < n:
        made = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            steps = np.full(max(n, PIECE + LENGTH + 1), base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        _powers[which] = (made[0], made[1])
    return _powers[which]


def _fingerprints(data: np.ndarray, length: int, which: int, at: np.ndarray) -> np.ndarray:
    """Of the strings of ``length`` bytes at the places ``at`` of ``data``: differences of running sums, shifted to place 0."""
    up, down = _power(which, len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[which][data] * up[: len(data)], dtype=np.uint64, out=total[1:])
    return (total[at + length] - total[at]) * down[at]


# --- sorted keys as bytes -----------------------------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """64-bit numbers as differences, byte plane by byte plane: of sorted keys the upper planes are next to nothing."""
    steps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    return len(values).to_bytes(4, "little") + _zipped(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T))


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    planes = _unzipped(data[4:], 8 * n).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _grouped(bucket: np.ndarray, key: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each bucket that has keys: (bucket, places in order of key, starts of equal ones, distinct keys)."""
    by = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[by], prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(by)) if len(by) else cuts, strict=True):
        some = by[a:b]
        some = some[np.argsort(key[some])]
        keys = key[some]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        yield int(bucket[some[0]]), some, starts, keys[starts]


def _sample_groups(block: Block) -> tuple[np.ndarray, Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    where, prints = block.samples()
    return where, _grouped(_top(prints, block.bits), prints << np.uint64(block.bits) >> np.uint64(32))


def _shared(block: Block, answers: dict[int, bytes]) -> np.ndarray:
    """Places of the samples whose rank is shared with another block, by the answers, or within this one."""
    where, groups = _sample_groups(block)
    found = [np.zeros(0, np.int64)]
    for bucket, places, starts, _ in groups:
        sizes = np.diff(starts, append=len(places))
        tied = _flags(answers.get(bucket), len(starts)) | (sizes > 1)
        found.append(where[places[np.repeat(tied, sizes)]])
    return np.concatenate(found)


def _flags(data: bytes | None, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool) if data is not None else np.zeros(n, bool)


def _firsts(places: np.ndarray, starts: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The earliest place of each group of equal suffixes; places of a block are in the order of its documents."""
    return np.minimum.reduceat(where[places], starts)


# --- the steps ----------------------------------------------------------------------------------------------


def copies(packed_blocks: DataFrame) -> DataFrame:
    """(block, copies): numbers within their block of the documents whose whole text an earlier one has."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["ids"], row["lengths"], row["bytes"], row["texts"], [], 0)
                begin = block.ends - block.lengths
                digest = [hashlib.blake2b(block.data[a:b], digest_size=16).digest() for a, b in zip(begin, block.ends, strict=True)]
                yield {"digest": digest, "doc_id": block.ids, "block": np.full(len(digest), row["block"]), "number": np.arange(len(digest))}

    rows = common.written(common.over_batches(packed_blocks, "digest binary, doc_id long, block long, number long", work), "digests")
    place = F.struct("doc_id", "block", "number")
    best = rows.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("digest", "first")
    best = common.sized(common.written(best, "repeated"))
    return rows.join(best, "digest").where(place != F.col("first")).groupBy("block").agg(F.collect_list("number").alias("copies"))


def _over_blocks(rows: DataFrame, schema: str, bits: int, work) -> DataFrame:
    """``work(row, block)`` for every block, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                yield from work(row, Block(row["ids"], row["lengths"], row["bytes"], row["texts"], row["copies"] or [], bits))

    return common.over_batches(rows, schema, run)


def _answers(row: dict, name: str) -> dict[int, bytes]:
    return {x["bucket"]: x["answer"] for x in row[name] or []}


def sampled(rows: DataFrame, bits: int) -> DataFrame:
    """(bucket, block, keys): the cover sample's keys, distinct within a block."""

    def work(row: dict, block: Block) -> Iterator[dict]:
        _, groups = _sample_groups(block)
        found = [(bucket, packed(keys)) for bucket, _, _, keys in groups]
        yield {"bucket": [b for b, _ in found], "block": np.full(len(found), row["block"]), "keys": [k for _, k in found]}

    return _over_blocks(rows, "bucket long, block long, keys binary", bits, work)


def sent(rows: DataFrame, bits: int) -> DataFrame:
    """(bucket, block, keys, ids): the suffixes that samples leave open, distinct within a block, with the first one's document."""

    def work(row: dict, block: Block) -> Iterator[dict]:
        where, buckets, keys = block.suffixes(_shared(block, _answers(row, "ranks")))
        found = []
        for bucket, places, starts, own in _grouped(buckets, keys):
            first = _firsts(places, starts, where)
            found.append((bucket, packed(own), packed(block.ids[np.searchsorted(block.ends, first, "right")])))
        b, k, i = zip(*found, strict=True) if found else ((), (), ())
        yield {"bucket": b, "block": np.full(len(found), row["block"]), "keys": k, "ids": i}

    return _over_blocks(rows, "bucket long, block long, keys binary, ids binary", bits, work)


def sorted_buckets(rows: DataFrame) -> DataFrame:
    """(block, bucket, answer): a bit for each key of (bucket, block, keys[, ids]).

    Without ids: whether another block has the key. With ids: whether an earlier document of another block has it.
    """
    located = "ids" in rows.columns

    def sort(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        keys = [unpacked(x.as_py()) for x in table.column("keys")]
        sizes = np.array([len(k) for k in keys])
        key = np.concatenate(keys)
        del keys
        order = np.argsort(key, kind="stable")  # equal ones stay in the order of blocks
        key = key[order]
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        many = np.diff(starts, append=len(key))
        del key
        if located:
            ids = np.concatenate([unpacked(x.as_py()) for x in table.column("ids")]).view(np.int64)[order]
            # the first of the smallest id
            least = np.repeat(np.minimum.reduceat(ids, starts), many)
            at = np.where(ids == least, np.arange(len(ids)), len(ids))
            told = np.arange(len(ids)) != np.repeat(np.minimum.reduceat(at, starts), many)
        else:
            told = np.repeat(many > 1, many)
        bits = np.zeros(len(order), bool)
        bits[order] = told
        ends = np.cumsum(sizes)
        answer = [np.packbits(bits[b - n : b]).tobytes() if bits[b - n : b].any() else None for b, n in zip(ends, sizes, strict=True)]
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "answer": pa.array(answer, pa.binary())}).filter(pa.array([a is not None for a in answer], pa.bool_()))

    return rows.groupBy("bucket").applyInArrow(sort, "block long, bucket long, answer binary")


def _by_block(answers: DataFrame, name: str) -> DataFrame:
    return answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "answer")).alias(name))


def cut(docs: DataFrame, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, spans (removed ones as ``begin:end`` in bytes, by comma) and kept_sha256 of every row of ``docs``.

    With ``texts`` also kept, the remaining bytes.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    size = min(MOST_BLOCK_BYTES, max(BLOCK_BYTES, total >> 10))
    density = len(COVER) / V
    # as many buckets as the sample needs, while a block still sends each some keys at once
    bits = 0
    while total * density > BUCKET << bits and size * density > 128 << bits:
        bits += 1
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = blocks(docs, size, count)
    known = rows.join(common.written(copies(rows), "copies"), "block", "left")
    ranks = common.written(_by_block(sorted_buckets(sampled(known, bits)), "ranks"), "ranks")
    known = known.join(ranks, "block", "left")
    answers = common.written(_by_block(sorted_buckets(sent(known, bits)), "repeats"), "repeats")

    def work(row: dict, block: Block) -> Iterator[dict]:
        where, buckets, keys = block.suffixes(_shared(block, _answers(row, "ranks")))
        repeats = _answers(row, "repeats")
        change = np.zeros(len(block.data) + 1, np.int8)  # at most LENGTH strings cover a byte
        for bucket, places, starts, _ in _grouped(buckets, keys):
            first = _firsts(places, starts, where)
            sizes = np.diff(starts, append=len(places))
            at = where[places]
            at = at[np.repeat(_flags(repeats.get(bucket), len(starts)), sizes) | (at != np.repeat(first, sizes))]
            change[at] += 1
            change[at + LENGTH] -= 1
        gone = np.cumsum(change[:-1], dtype=np.int8) > 0
        begin = block.ends - block.lengths
        for k in np.flatnonzero(~block.live & (block.lengths >= LENGTH)):
            gone[begin[k] : block.ends[k]] = True
        out: dict[str, list] = {"doc_id": [], "n_bytes": [], "spans": [], "kept_sha256": [], "kept": []}
        for i, a, b in zip(block.ids, begin, block.ends, strict=True):
            own = gone[a:b]
            left = block.data[a:b][~own].tobytes()
            turns = np.flatnonzero(np.diff(own, prepend=False, append=False)) if own.any() else np.zeros(0, np.int64)
            out["doc_id"].append(None if i == _NO_ID else int(i))
            out["n_bytes"].append(int(b - a))
            out["spans"].append(",".join(f"{x}:{y}" for x, y in turns.reshape(-1, 2)))
            out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
            out["kept"].append(left if texts else None)
        yield out

    schema = "doc_id long, n_bytes long, spans string, kept_sha256 string, kept binary"
    done = _over_blocks(known.join(answers, "block", "left"), schema, bits, work)
    return done if texts else done.drop("kept")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cut(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.when(F.col("spans") == "", F.array().cast("array<string>")).otherwise(F.split("spans", ","))
    length = F.aggregate(spans, F.lit(0).cast("long"), lambda t, x: t + F.split(x, ":")[1].cast("long") - F.split(x, ":")[0].cast("long"))
    return found.select("doc_id", "n_bytes", length.alias("n_removed"), F.size(spans).cast("long").alias("n_spans"), "kept_sha256")


# every string of 100 bytes of every text, in hexadecimal digits
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, h, unnest(range(len(h) // 2 - 99)) AS i FROM d WHERE len(h) >= 200),
s AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS g FROM w),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM s),
r AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM f WHERE k > 1),
n AS (SELECT doc_id, i, sum(CASE WHEN b IS NULL OR i > b + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
u AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS z FROM n GROUP BY doc_id, run),
k AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS y FROM u),
p AS (
  SELECT d.doc_id, count(*) AS n_spans, sum(z - a) AS n_removed,
    string_agg(substr(any_h, 2 * y + 1, 2 * (a - y)), '' ORDER BY a) || substr(max(any_h), 2 * max(z) + 1) AS left_h
  FROM k JOIN (SELECT doc_id, h AS any_h FROM d) d ON k.doc_id = d.doc_id GROUP BY d.doc_id
)
SELECT d.doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(left_h, h))) AS kept_sha256
FROM d LEFT JOIN p ON d.doc_id = p.doc_id
"""
