"""Substring dedup by hashed units: the first occurrence in the corpus stays, the rest go with their offsets kept.

A unit is a line, of any length, and where a line holds several pieces each of these as well, so that a passage set into
a paragraph is met. Pieces end with sentences; a sentence of more than ``LONGEST`` words, or text without sentence ends,
is also cut after words that their own hash picks, so that a passage is cut alike wherever it stands. Units are
normalised (A-Z in lower case, white space runs as one space). A piece of fewer than ``LEAST_WORDS`` words is hashed
with the pieces before it that make up so many words, or with those after it where the text's start comes first; what
is removed is the piece alone. (With both for every piece there are half as many digests again, and of the passages
of 51 words that 129 documents of 229 repeat nine tenths go, instead of 124.)

Digests (96 bits) are grouped over the whole corpus. Of equal ones that of the smallest (doc_id, start) stays. A kept piece
may stand in a line that goes, if that whole line stands before it elsewhere. Removed units that follow one another and
have their keepers side by side are one row.

Null and empty texts have no units. A null doc_id ranks after all others. Repeated rows of one id and text are one
occurrence: they keep and lose the same units; rows of one id with different texts (by their CRC-32) are told apart. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

LEAST_WORDS, LONGEST = 10, 32
#: One of so many words ends a piece of a long sentence.
ONE_OF = 16
_END = re.compile(r"[.!?]+[\x20\x09\x0B-\x0D]+|\n+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*\n*")
_WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
#: The line of a unit that is a line itself.
_WHOLE = -1


def pieces(text: str) -> list[tuple[int, int, list[bytes], int]]:
    """(start, end, words, start of its line) of the pieces of a text, in order; those without words are left out."""
    found: list[tuple[int, int, list[bytes], int]] = []
    start = line = 0
    for end, last in [*((m.end(), m[0][-1] == "\n") for m in _END.finditer(text)), (len(text), True)]:
        words = text[start:end].encode().lower().split()  # of bytes: ASCII letters and white space alone
        if len(words) > LONGEST:
            at, own = start, []
            for m in _WORD.finditer(text, start, end):
                word = m[0].rstrip(_WHITE).encode().lower()
                own.append(word)
                if zlib.crc32(word) % ONE_OF == 0 and m.end() < end:
                    found.append((at, m.end(), own, line))
                    at, own = m.end(), []
            if own:
                found.append((at, end, own, line))
        elif words:
            found.append((start, end, words, line))
        start = end
        if last:
            line = end
    return found


def units(text: str) -> Iterator[tuple[int, int, int, bytes]]:
    """(start, end, line, digest): lines with ``_WHOLE`` as their line, then the pieces of lines that hold several."""
    found = pieces(text)
    sizes = [len(p[2]) for p in found]
    k = 0
    while k < len(found):
        line = found[k][3]
        to = k + 1
        while to < len(found) and found[to][3] == line:
            to += 1
        yield line, found[to - 1][1], _WHOLE, _digest([w for p in found[k:to] for w in p[2]])
        if to - k > 1:
            for i in range(k, to):
                start, end, words, _ = found[i]
                if sizes[i] >= LEAST_WORDS:
                    yield start, end, line, _digest(words)
                    continue
                a, n = i, sizes[i]
                while n < LEAST_WORDS and a:
                    a -= 1
                    n += sizes[a]
                if n >= LEAST_WORDS:
                    yield start, end, line, _digest([w for p in found[a : i + 1] for w in p[2]], b"<%d" % sizes[i])
                    continue
                b, n = i + 1, sizes[i]
                while n < LEAST_WORDS and b < len(found):
                    n += sizes[b]
                    b += 1
                if n >= LEAST_WORDS:
                    yield start, end, line, _digest([w for p in found[i:b] for w in p[2]], b">%d" % sizes[i])
        k = to


def _digest(words: list[bytes], mark: bytes = b"") -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=12, person=mark).digest()


def occurrences(docs: DataFrame) -> DataFrame:
    """(key, more, doc_id, text, start, end, line) of every unit; key and more are its digest, text is its text's CRC-32."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                rows, found, sums = [], [], []
                for i, text in enumerate(common.as_text(part.column("text"))):
                    text = text.as_py()
                    got = list(units(text))
                    found += got
                    rows += [i] * len(got)
                    sums += [zlib.crc32(text.encode())] * len(got)
                if found:
                    start, end, line, digest = zip(*found, strict=True)
                    digest = np.frombuffer(b"".join(digest), np.dtype([("key", "<i8"), ("more", "<i4")]))
                    yield {
                        "key": np.ascontiguousarray(digest["key"]), "more": np.ascontiguousarray(digest["more"]),
                        "doc_id": part.column("doc_id").take(pa.array(rows, pa.int64())), "text": sums, "start": start, "end": end, "line": line,
                    }

    return common.over_batches(docs.select("doc_id", "text"), "key long, more int, doc_id long, text long, start int, end int, line int", work)


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, text, start, end, keep_doc_id, keep_start): a row for every run of removed units, offsets in code points."""
    found = common.written(occurrences(docs), "units")  # read for the groups and for the removal
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "start")
    # smallest place and largest differ: the unit occurs again
    best = found.groupBy("key", "more").agg(F.min(place).alias("first"), F.max(place).alias("other")).where("first <> other")
    # written, so that Spark can split a digest that occurs everywhere in the join
    best = common.written(best.select("key", "more", F.col("first.doc_id").alias("keep_doc_id"), F.col("first.start").alias("keep_start")), "repeated")
    rows = found.join(best, ["key", "more"])
    stays = F.col("doc_id").eqNullSafe(F.col("keep_doc_id")) & (F.col("start") == F.col("keep_start"))
    # from here on by document
    keeper = F.struct(F.col("keep_doc_id").isNull().alias("last"), "keep_doc_id", "keep_start")
    rows = rows.where(~stays).select("doc_id", "text", "line", "start", "end", keeper.alias("keeper")).repartition("doc_id", "text")
    rows = rows.groupBy("doc_id", "text", "line", "start", "end").agg(F.min("keeper").alias("keeper"))
    gone = F.max(F.when(F.col("line") == _WHOLE, True)).over(W.partitionBy("doc_id", "text", F.when(F.col("line") == _WHOLE, F.col("start")).otherwise(F.col("line"))))
    rows = rows.withColumn("gone", gone).where((F.col("line") == _WHOLE) | F.col("gone").isNull())
    ordered = W.partitionBy("doc_id", "text").orderBy("start")
    goes_on = (
        (F.lag("end").over(ordered) == F.col("start")) & F.lag("keeper.keep_doc_id").over(ordered).eqNullSafe(F.col("keeper.keep_doc_id"))
        & (F.lag(F.col("keeper.keep_start") - F.col("start")).over(ordered) == F.col("keeper.keep_start") - F.col("start"))
    )
    rows = rows.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("new").over(ordered))
    return rows.groupBy("doc_id", "text", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("keeper").alias("keeper")
    ).select("doc_id", "text", "start", "end", "keeper.keep_doc_id", "keeper.keep_start")


def cleaned(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """doc_id, text without the removed units, and their spans ``start:end`` in the original, of every row of ``docs``."""
    spans = removed.groupBy(F.col("doc_id").alias("of"), F.col("text").alias("sum")).agg(F.array_join(F.array_sort(F.collect_set(F.format_string("%012d:%012d", "start", "end"))), ",").alias("spans"))
    rows = docs.select("doc_id", "text")
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.crc32(F.coalesce(F.col("text"), F.lit(""))) == F.col("sum"))
    rows = rows.join(spans, same, "left").select("doc_id", "text", F.coalesce("spans", F.lit("")).alias("spans"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts, lists = [], []
            for text, joined in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                cut = [tuple(map(int, s.split(":"))) for s in joined.split(",")] if joined else []
                at, kept = 0, []
                for a, b in cut:
                    kept.append(text[at:a])
                    at = b
                texts.append(text if not cut or text is None else "".join([*kept, text[at:]]))
                lists.append(",".join(f"{a}:{b}" for a, b in cut))
            yield {"doc_id": batch.column("doc_id"), "text": texts, "removed": lists}

    return common.over_batches(rows, "doc_id long, text string, removed string", work)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The removed units, with the number of code points that the removal leaves of the document (the most, where rows share an id)."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = common.written(repeated(docs), "removed")
    gone = removed.groupBy("doc_id", "text").agg(F.sum(F.col("end") - F.col("start")).alias("gone"))
    length = docs.select(F.col("doc_id").alias("of"), F.crc32(F.coalesce("text", F.lit(""))).alias("sum"), F.length("text").alias("n_chars"))
    left = length.join(gone, F.col("of").eqNullSafe(F.col("doc_id")) & (F.col("sum") == F.col("text"))).groupBy("of").agg(F.max(F.col("n_chars") - F.col("gone")).alias("n_chars_left"))
    out = removed.join(left, F.col("doc_id").eqNullSafe(F.col("of")))
    return out.select("doc_id", F.col("start").cast("long"), F.col("end").cast("long"), "keep_doc_id", F.col("keep_start").cast("long"), "n_chars_left")
