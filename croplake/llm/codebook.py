"""Vectors as codes of their parts: Lloyd's rounds whose members stay with the owner of their entry.

Every vector is cut into equal parts; each position has its own codebook. A part is a row that lives with the owner of
its (position, entry, salt): the first assignment deals all parts out to their owners and writes them there. In a round

1. owners add up their resident members; a sum and a count per (position, entry, salt) leave them, and make the next
   codebook, which is small (positions x entries x width numbers) and told to all;
2. owners look at their residents again; a part whose nearest entry is still its own stays where it lies, without being
   written or shuffled; only parts that change their entry migrate, to a table of this round's arrivals.

A table of arrivals is never written again: who has left it since is known by the codebooks of the rounds after it. The
salt follows from the row and spreads an entry, so that an owner holds about ``OWNER_ROWS`` members at most, also when
all vectors choose one entry.

Components are integers, floor(256 * x), held within +-2**27 so that no sum of squares overflows. Dropped are vectors
that are null or hold a null or non-finite component. A vector of another length than the first kept one (smallest
vec_id), or one that doesn't divide into the positions, has no such parts and is dropped as well. Of rows with one vec_id
the one with the smaller vector, component by component, comes first; null ids come last. Fewer vectors than entries make
a smaller codebook. An entry without members stays as it is. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

POSITIONS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
#: Members of one owner, about, if all chose one entry.
OWNER_ROWS = 4096
#: Parts compared with a codebook at once.
CHUNK = 4096
_LARGEST = 1 << 27

#: (position, entry, component)
Codebooks = np.ndarray

_PART = "row long, position int, entry int, salt long, part binary, vec_id long, label long"


def whole(vectors: DataFrame, positions: int = POSITIONS) -> DataFrame:
    """(row, vec_id, label, components) of the kept rows of ``vectors(vec_id, embedding, label)``; components are int arrays."""
    x = F.col("embedding")
    # nan and infinities fail both comparisons
    fine = x.isNotNull() & (F.size(x) > 0) & (F.size(x) % positions == 0) & F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))) & ~F.isnan(c))
    scaled = F.transform(x, lambda c: F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), F.floor(c.cast("double") * SCALE))).cast("int"))
    found = vectors.where(F.coalesce(fine, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), F.col("label").cast("long"), scaled.alias("components")
    )
    found = common.written(found, "vectors")  # the rows' numbers hold from here on
    first = found.orderBy(*_order()).limit(1).select(F.size("components").alias("n")).collect()
    return found.where(F.size("components") == (first[0]["n"] if first else 0))


def _order() -> list[Column]:
    return [F.col("vec_id").asc_nulls_last(), F.col("components").asc(), F.col("label").asc_nulls_last()]


def start(found: DataFrame, positions: int, entries: int) -> Codebooks:
    """The codebooks of the first ``entries`` vectors."""
    rows = [r["components"] for r in found.orderBy(*_order()).limit(entries).select("components").collect()]
    width = len(rows[0]) // positions if rows else 0
    return np.array(rows, np.int64).reshape(len(rows), positions, width).transpose(1, 0, 2)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each of ``parts``; of equally near entries the first."""
    entry, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    for at in range(0, len(parts), CHUNK):
        some = parts[at : at + CHUNK]
        apart = np.zeros((len(some), len(book)), np.int64)
        for k in range(book.shape[1]):
            apart += (some[:, k, None] - book[None, :, k]) ** 2
        best = apart.argmin(axis=1)
        entry[at : at + CHUNK], distance[at : at + CHUNK] = best, apart[np.arange(len(some)), best]
    return entry, distance


def _assigned(batch: pa.RecordBatch, books: list[Codebooks]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(resident, entry, distance, parts) of a batch of members: who has stayed through all of ``books`` but the last, and what the last says."""
    position, own = batch.column("position").to_numpy(), batch.column("entry").to_numpy()
    parts = np.frombuffer(b"".join(batch.column("part").to_pylist()), np.int32).reshape(batch.num_rows, -1).astype(np.int64)
    resident, entry, distance = np.ones(len(own), bool), own.astype(np.int64), np.zeros(len(own), np.int64)
    for k, book in enumerate(books):
        for p in np.unique(position):
            at = np.flatnonzero((position == p) & resident)
            entry[at], distance[at] = nearest(parts[at], book[p])
        if k < len(books) - 1:
            resident &= entry == own
    return resident, entry, distance, parts


def dealt(found: DataFrame, book: Codebooks, salts: int) -> DataFrame:
    """Every part with its nearest entry, at its owner. ``vec_id`` and ``label`` go with the first position's part."""
    positions = len(book)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                some = batch.slice(at, CHUNK)
                n = some.num_rows
                parts = np.stack(some.column("components").to_numpy(zero_copy_only=False)).astype(np.int32).reshape(n, positions, -1)
                row = some.column("row").to_numpy()
                for p in range(positions):
                    entry, _ = nearest(parts[:, p].astype(np.int64), book[p])
                    mine = np.ascontiguousarray(parts[:, p])
                    yield {
                        "row": row, "position": np.full(n, p), "entry": entry, "salt": row % salts, "part": [x.tobytes() for x in mine],
                        "vec_id": some.column("vec_id") if p == 0 else pa.nulls(n), "label": some.column("label") if p == 0 else pa.nulls(n),
                    }

    return _at_owners(common.over_batches(found, _PART, work))


def _at_owners(parts: DataFrame) -> DataFrame:
    return common.written(parts.repartition("position", "entry", "salt"), "members")


def moved(members: DataFrame, books: list[Codebooks]) -> DataFrame:
    """The residents of ``members`` that the last of ``books`` gives another entry, with it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            resident, entry, _, _ = _assigned(batch, books)
            go = resident & (entry != batch.column("entry").to_numpy())
            some = common.passing(batch, go)
            yield {c: some.column(c) for c in batch.schema.names} | {"entry": entry[go]}

    return common.over_batches(members, _PART, work)


def sums(members: DataFrame, books: list[Codebooks]) -> DataFrame:
    """(position, entry, component, total, count) over the residents of ``members``, added up where they lie."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("entry").to_numpy()
            resident, entry, _, parts = _assigned(batch, books)
            stay = resident & (entry == own)
            key = batch.column("position").to_numpy()[stay].astype(np.int64) << 32 | own[stay]
            keys, at, count = np.unique(key, return_inverse=True, return_counts=True)
            total = np.zeros((len(keys), parts.shape[1]), np.int64)
            np.add.at(total, at, parts[stay])
            width = parts.shape[1]
            yield {
                "position": np.repeat(keys >> 32, width), "entry": np.repeat(keys & 0xFFFFFFFF, width),
                "component": np.tile(np.arange(width), len(keys)), "total": total.ravel(), "n": np.repeat(count, width),
            }

    got = common.over_batches(members, "position int, entry int, component int, total long, n long", work)
    return got.groupBy("position", "entry", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def updated(book: Codebooks, found: DataFrame) -> Codebooks:
    """Entries with members become the floor of their mean; at most positions x entries x width rows are read."""
    book = book.copy()
    for r in found.collect():
        book[r["position"], r["entry"], r["component"]] = r["total"] // r["n"]
    return book


def compress(vectors: DataFrame, positions: int = POSITIONS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, codes, error) of every kept row, codes as an int array; and the codebooks."""
    found = whole(vectors, positions)
    book = start(found, positions, entries)
    if not book.size:
        return vectors.sparkSession.createDataFrame([], "vec_id long, label long, codes array<int>, error long"), book
    salts = max(1, -(-found.count() // OWNER_ROWS))
    arrived = [(dealt(found, book, salts), 0)]  # members, and how many rounds' books they were dealt by
    books: list[Codebooks] = []
    for k in range(rounds):
        # who is resident after the rounds so far: the books that a table has not been dealt by
        got = [sums(members, books[since:]) for members, since in arrived]
        total = got[0]
        for more in got[1:]:
            total = total.unionByName(more)
        total = total.groupBy("position", "entry", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        book = updated(book, total)
        books.append(book)
        if k < rounds - 1:
            going = moved(arrived[0][0], books)
            for members, since in arrived[1:]:
                going = going.unionByName(moved(members, books[since:]))
            arrived.append((_at_owners(going), k + 1))
    books = books or [book]  # without rounds the first assignment is the last
    final = None
    for members, since in arrived:
        part = _final(members, books[since:])
        final = part if final is None else final.unionByName(part)
    code = [F.max(F.when(F.col("position") == p, F.col("entry"))) for p in range(positions)]
    codes = final.groupBy("row").agg(
        F.max("vec_id").alias("vec_id"), F.max("label").alias("label"), F.array(*code).alias("codes"), F.sum("distance").alias("error")
    )
    return codes.drop("row"), book


def _final(members: DataFrame, books: list[Codebooks]) -> DataFrame:
    """(row, position, entry, distance, vec_id, label) of the residents before the last of ``books``, by that one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            resident, entry, distance, _ = _assigned(batch, books)
            some = common.passing(batch, resident)
            yield {c: some.column(c) for c in ("row", "position", "vec_id", "label")} | {"entry": entry[resident], "distance": distance[resident]}

    return common.over_batches(members, "row long, position int, entry int, distance long, vec_id long, label long", work)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes as two hex digits each, with the labels' sums and the digest of all final entries."""
    codes, book = compress(common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    codes = common.written(codes, "codes")
    labels = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    hexed = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    labels = common.sized(common.written(labels, "labels"))
    return codes.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", hexed.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _lloyd_sql() -> str:
    """Both rounds written out: distances of every part to every entry, the first nearest one, floors of the means."""

    def assigned(book: str) -> str:
        return (
            f"SELECT vec_id, p, e, d FROM (SELECT x.vec_id, x.p, b.e, sum((x.x - b.x) * (x.x - b.x)) AS d, "
            f"row_number() OVER (PARTITION BY x.vec_id, x.p ORDER BY sum((x.x - b.x) * (x.x - b.x)), b.e) AS k "
            f"FROM x JOIN {book} b ON x.p = b.p AND x.j = b.j GROUP BY x.vec_id, x.p, b.e) WHERE k = 1"
        )

    def moved_book(book: str, by: str) -> str:
        return (
            f"SELECT b.p, b.e, b.j, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN (SELECT a.p, a.e, x.j, "
            f"CAST(floor(CAST(sum(x.x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM {by} a JOIN x ON a.vec_id = x.vec_id AND a.p = x.p GROUP BY a.p, a.e, x.j) m "
            f"ON b.p = m.p AND b.e = m.e AND b.j = m.j"
        )

    return f"""
WITH v AS (
  SELECT vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), c AS (SELECT vec_id, label, CAST(floor(CAST(unnest(v) AS DOUBLE) * 256) AS BIGINT) AS x, unnest(range(len(v))) AS k, len(v) // 16 AS w FROM v),
x AS (SELECT vec_id, CAST(k // w AS INTEGER) AS p, CAST(k % w AS INTEGER) AS j, x FROM c),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v QUALIFY e < 64),
b0 AS (SELECT x.p, f.e, x.j, x.x FROM x JOIN f ON x.vec_id = f.vec_id),
a0 AS ({assigned("b0")}), b1 AS ({moved_book("b0", "a0")}),
a1 AS ({assigned("b1")}), b2 AS ({moved_book("b1", "a1")}),
a2 AS ({assigned("b2")}),
r AS (SELECT vec_id, string_agg(lower(printf('%02x', CAST(e AS INTEGER))), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY vec_id),
s AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM b2)
SELECT r.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, s.codebooks_sha256
FROM r JOIN v ON r.vec_id = v.vec_id, s
"""


ORACLE_SQL = _lloyd_sql()
