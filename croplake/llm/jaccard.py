"""Exact join of documents whose sets of word shingles are similar, by prefix index lists and set relations.

1. A document becomes the ordered set of its shingles' 64-bit hashes; equal sets are one set from here on.
2. Shingles are ordered by hash, the most frequent ones last. Two similar sets share one of their first
   ``n - ceil(share * n) + 1`` shingles; these go to index lists, each held in order of position. If the first
   common shingle stands at positions i and j, then i + j of the shingles before it aren't common; what lies
   further on in the list than the sets' sizes allow is skipped.
3. Every list's first set (the one with the fewest rare shingles, as an original has among its variants) leads.
   Each set is compared with the leader that it meets in most lists: one pair a set, never all pairs of a list.
4. The answers of the rest are derived from these: sets that their leaders connect need no pair of their own, and
   where the known overlaps with a list's leader bound a pair's overlap below the threshold, the pair is skipped.
   Pairs between components that neither settles are compared, those of a few neighbours in a list first, after an exact bound from the sets' parity bits.
   A long list is dealt out as blocks of sets, pair of blocks by pair of blocks.
5. Links are joined to components by stars (:func:`common.components`).

All comparisons are of whole sets. What the order of shingles is, which sets lead and how lists are cut changes the
work, never the result. Null and empty texts have an empty set and link with nothing; texts of fewer than ``k``
words have one shingle of them all. Rows without an id belong to components as others do, but name none. Repeated
rows are repeated in the result. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

WORDS, PERCENT = 5, 80
#: A shingle in more rows than this counts as frequent; so many of the most frequent ones are told to all tasks (8 bytes each).
FREQUENT, TOLD = 12, 1 << 18
#: Sets in a block of a long list.
BLOCK = 1024
#: Bytes of the bits that stand for a set within the lists.
BRIEF = 64
#: Neighbours in a list that a set is compared with before all pairs still open are.
NEAREST = 2
#: Sets that a task remembers, not to post an equal set again (they would be dropped from the lists anyway).
REMEMBERED = 200_000


def _fingerprint(found: np.ndarray) -> np.uint64:
    return tokens.mix(np.array([tokens.mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(found))], np.uint64))[0]


def described(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, fp, bits, brief): size, fingerprint and bits of every row's set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in common.parts(batches):
            n, fp, bits = [], [], []
            for found in tokens.sets(common.as_text(batch.column("text")), k):
                n.append(len(found))
                fp.append(_fingerprint(found))
                bits.append(_bits(found))
            yield {"doc_id": batch.column("doc_id"), "n": n, "fp": tokens.signed(np.array(fp, np.uint64)), "bits": bits, "brief": [_brief(x) for x in bits]}

    return common.over_batches(docs.select("doc_id", "text"), "doc_id long, n long, fp long, bits binary, brief binary", work)


def frequent(docs: DataFrame, k: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, among those that can come into a prefix, and their numbers of rows.

    Counted over all documents are first the shingles that a set's prefix, or a quarter more, holds in order of hash
    alone; then all shingles of the sets whose prefix reaches further once the frequent ones go last.
    """

    def window(found: np.ndarray) -> int:
        return _prefix(len(found), percent) * 5 // 4 + 10

    def counted(pick: Callable[[np.ndarray], np.ndarray]) -> dict[int, int]:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in common.parts(batches, 2000):
                some = [pick(found) for found in tokens.sets(common.as_text(batch.column("text")), k)]
                if some:
                    yield dict(zip(("token", "rows"), np.unique(tokens.signed(np.concatenate(some)), return_counts=True), strict=True))

        rows = common.over_batches(docs.select("text"), "token long, rows long", work).groupBy("token").agg(F.sum("rows").alias("rows"))
        top = rows.where(F.col("rows") > FREQUENT).orderBy(F.desc("rows"), "token").limit(TOLD).toPandas()
        return dict(zip(top["token"], top["rows"], strict=True))

    def ordered(counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        names = np.fromiter(counts, np.int64, len(counts)).view(np.uint64)
        order = np.argsort(names)
        return names[order], np.fromiter(counts.values(), np.int64, len(counts))[order]

    counts = counted(lambda found: found[: window(found)])
    told = docs.sparkSession.sparkContext.broadcast(ordered(counts))

    def beyond(found: np.ndarray) -> np.ndarray:
        rare = (~_isin(found[: window(found)], told.value[0])).sum()
        return found if rare < _prefix(len(found), percent) else found[:0]

    counts |= counted(beyond)
    return ordered(dict(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:TOLD]))


def _prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _isin(found: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered) or not len(found):
        return np.zeros(len(found), bool)
    return ordered[np.minimum(np.searchsorted(ordered, found), len(ordered) - 1)] == found


def _ordered(found: np.ndarray, often: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The rare shingles by hash, then the frequent ones from the rarest on."""
    hot = _isin(found, often[0])
    if not hot.any():
        return found
    last = found[hot]
    return np.concatenate((found[~hot], last[np.argsort(often[1][np.searchsorted(often[0], last)], kind="stable")]))


def _least_common(total: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap that makes two sets of ``total`` shingles together similar: 100 * o >= percent * (total - o)."""
    return -(-percent * total // (100 + percent))


def postings(docs: DataFrame, k: int, percent: int, often: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(token, pos, n, fp): the prefix of every set, once a task."""
    told = docs.sparkSession.sparkContext.broadcast(often)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen: set[int] = set()
        for batch in common.parts(batches):
            parts, sizes, prints = [], [], []
            for found in tokens.sets(common.as_text(batch.column("text")), k):
                if not len(found) or (fp := int(_fingerprint(found))) in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(fp)
                n = len(found)
                parts.append(_ordered(found, told.value)[: _prefix(n, percent)])
                sizes.append(n)
                prints.append(fp)
            if parts:
                lengths = [len(x) for x in parts]
                yield {
                    "token": tokens.signed(np.concatenate(parts)), "pos": np.concatenate([np.arange(x) for x in lengths]),
                    "n": np.repeat(sizes, lengths), "fp": np.repeat(tokens.signed(np.array(prints, np.uint64)), lengths),
                }

    return common.over_batches(docs.select("text"), "token long, pos int, n int, fp long", work)


def led(posted: DataFrame) -> DataFrame:
    """Every posting but the first of its list, with the first one: (token, pos, n, fp, lpos, ln, lfp).

    A list is read in order of position, as a stream: only its first posting is held.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        last: tuple[np.ndarray, ...] | None = None  # one-row columns: first posting of the open list, and its last set
        for batch in batches:
            if not batch.num_rows:
                continue
            token, pos, n, fp = (batch.column(c).to_numpy() for c in ("token", "pos", "n", "fp"))
            if last is not None:
                token, pos, n, fp = (np.concatenate((a, b)) for a, b in zip(last[:4], (token, pos, n, fp), strict=True))
            new = np.concatenate(([True], token[1:] != token[:-1]))
            first = np.maximum.accumulate(np.where(new, np.arange(len(token)), 0))
            fresh = ~new & (fp != fp[first]) & np.concatenate(([True], fp[1:] != fp[:-1]))
            if last is not None:
                fresh[1:2] &= fp[1:2] != last[4]
            f = first[fresh]
            yield {"token": token[fresh], "pos": pos[fresh], "n": n[fresh], "fp": fp[fresh], "lpos": pos[f], "ln": n[f], "lfp": fp[f]}
            at = first[-1:]
            last = (token[at], pos[at], n[at], fp[at], fp[-1])

    lists = posted.repartition("token").sortWithinPartitions("token", "pos", "n", "fp")
    return common.over_batches(lists, "token long, pos int, n int, fp long, lpos int, ln int, lfp long", work)


def links(pairs: DataFrame, described_rows: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The similar ones of ``pairs(afp, an, bfp, bn)``, with ``common``, the size of the intersection of the whole sets.

    The sets' bits come first: bits that differ are shingles that only one set has, so that a pair they put too far
    apart is none. Whole sets are made again, from one document each, for the pairs that are left.
    """
    bits = described_rows.join(_nodes(pairs), "fp", "left_semi").groupBy("fp").agg(F.first("bits").alias("bits"), F.min("doc_id").alias("doc_id"))
    bits = common.written(bits, "bits")
    both = pairs.join(bits.select(F.col("fp").alias("afp"), F.col("bits").alias("a")), "afp").join(bits.select(F.col("fp").alias("bfp"), F.col("bits").alias("b")), "bfp")

    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            total = batch.column("an").to_numpy().astype(np.int64) + batch.column("bn").to_numpy()
            apart = np.array([_apart(x.as_py(), y.as_py()) for x, y in zip(batch.column("a"), batch.column("b"), strict=True)], np.int64)
            ok = common.passing(batch, (total - apart) // 2 >= _least_common(total, percent))
            yield {c: ok.column(c) for c in ("afp", "an", "bfp", "bn")}

    close = common.written(common.over_batches(both.select("afp", "an", "bfp", "bn", "a", "b"), "afp long, an int, bfp long, bn int", sieve), "close")
    ids = common.written(bits.join(_nodes(close), "fp", "left_semi").select("doc_id"), "needed")
    some = common.with_ids(docs.select("doc_id", "text"), ids, "doc_id", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in common.parts(batches, 256):
            part = list(tokens.sets(common.as_text(batch.column("text")), k))
            if part:
                yield {"fp": tokens.signed(np.array([_fingerprint(x) for x in part], np.uint64)), "found": [x.tobytes() for x in part]}

    whole = common.over_batches(some.select("text"), "fp long, found binary", sets).dropDuplicates(["fp"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            got = [len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), assume_unique=True)) for x, y in zip(a, b, strict=True)]
            yield {c: batch.column(c) for c in ("afp", "an", "bfp", "bn")} | {"common": got}

    both = close.join(whole.select(F.col("fp").alias("afp"), F.col("found").alias("a")), "afp").join(whole.select(F.col("fp").alias("bfp"), F.col("found").alias("b")), "bfp")
    counted = common.over_batches(both.select("afp", "an", "bfp", "bn", "a", "b"), "afp long, an int, bfp long, bn int, common int", count)
    return common.written(counted.where(F.col("common") * (100 + percent) >= F.lit(percent) * (F.col("an") + F.col("bn"))), "links")


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("afp").alias("fp")).union(pairs.select(F.col("bfp").alias("fp"))).distinct()


def _bits(found: np.ndarray) -> bytes:
    """A bit for each of at least 4 n places: whether an odd number of the set's shingles fall there."""
    size = 1 << max(9, int(4 * len(found) - 1).bit_length())
    return np.packbits(np.bincount((found & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).tobytes()


def _brief(bits: bytes) -> bytes:
    """Bits folded to the shortest size there is."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint8).reshape(-1, BRIEF), axis=0).tobytes()


def _apart(a: bytes, b: bytes) -> int:
    """Shingles that only one of two sets has are at least so many; the longer bits are folded to the shorter."""
    x, y = (a, b) if len(a) >= len(b) else (b, a)
    long = int.from_bytes(x, "little")
    half = len(x) * 8
    while half > len(y) * 8:
        half //= 2
        long = (long >> half) ^ (long & ((1 << half) - 1))
    return (long ^ int.from_bytes(y, "little")).bit_count()


def _open(members: DataFrame, briefs: DataFrame, led_by: DataFrame, roots: DataFrame, percent: int, nearest: int | None) -> DataFrame:
    """Pairs of different components within lists that the leaders' answers leave open: (afp, an, bfp, bn).

    With ``nearest``, each set with so many that follow it in its block of the list only.
    """
    answered = led_by.select(F.col("afp").alias("lfp"), F.col("bfp").alias("fp"), "common")
    rows = members.join(common.sized(answered), ["lfp", "fp"], "left").join(common.sized(roots), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rows = common.written(rows, "answered")
    several = rows.groupBy("token").agg(F.count("*").alias("sets"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    rows = rows.join(common.sized(common.written(several.select("token", "sets"), "several")), "token").join(briefs, "fp")
    blocks = F.ceil(F.col("sets") / BLOCK)
    own = F.pmod(F.xxhash64("fp"), blocks)
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)) if nearest is None else own)
    rows = rows.withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other"))
    columns = ("token", "x", "y", "pos", "n", "fp", "ln", "common", "root", "own", "brief")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            got = [(c.fill_null(-1) if c.null_count else c).to_numpy().astype(np.int64) for c in (batch.column(name) for name in columns[:-1])]
            got.append(np.frombuffer(b"".join(batch.column("brief").to_pylist()), np.uint64).reshape(-1, BRIEF // 8))
            if held is not None:
                got = [np.concatenate(z) for z in zip(held, got, strict=True)]
            cut = np.flatnonzero((got[0][1:] != got[0][:-1]) | (got[1][1:] != got[1][:-1]) | (got[2][1:] != got[2][:-1])) + 1
            ends = [0, *cut]
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                yield from _open_pairs([c[a:b] for c in got], percent, nearest)
            held = [c[ends[-1] :] for c in got]
        if held is not None:
            yield from _open_pairs(held, percent, nearest)

    cells = rows.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y", "pos", "n", "fp").select(*columns)
    return common.over_batches(cells, "afp long, an int, bfp long, bn int", work).distinct()


def _open_pairs(cell: list[np.ndarray], percent: int, nearest: int | None) -> Iterator[dict]:
    """The open pairs of one cell, which is in order of position and holds two blocks of sets at most."""
    _, x, y, pos, n, fp, ln, answer, root, own, brief = cell
    if (root == root[0]).all():
        return
    known = answer >= 0
    high = np.where(known, answer, np.minimum(n, ln))  # of the overlap with the leader
    out = np.where(known, n - answer, n)  # at most so many shingles that the leader hasn't
    for i in range(len(fp)):
        widest = n[i] + n[i] * 100 // percent
        last = np.searchsorted(pos, widest * (100 - percent) // (100 + percent) + 1 - pos[i], "right")  # further on no set is similar
        j = i + 1 + np.flatnonzero(root[i + 1 : last] != root[i])
        if not len(j):
            continue
        total = n[i] + n[j]
        least = _least_common(total, percent)
        ok = (pos[i] + pos[j] <= total - 2 * least) & (np.minimum(n[i], n[j]) >= least)
        ok &= np.minimum(high[i], high[j]) + np.minimum(out[i], out[j]) >= least
        if x[i] != y[i]:
            ok &= own[j] != own[i]
        j, total, least = j[ok], total[ok], least[ok]
        # bits that differ are shingles that only one of the two has
        apart = np.bitwise_count(brief[j] ^ brief[i]).sum(axis=1, dtype=np.int64)
        j = j[(total - apart) // 2 >= least][:nearest]
        if len(j):
            swap = fp[j] < fp[i]
            yield {
                "afp": np.where(swap, fp[j], fp[i]), "an": np.where(swap, n[j], n[i]),
                "bfp": np.where(swap, fp[i], fp[j]), "bn": np.where(swap, n[i], n[j]),
            }


def similar(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row of ``docs(doc_id, text)``."""
    docs = docs.select("doc_id", "text")
    rows = common.written(described(docs, k), "described")
    members = common.written(led(postings(docs, k, percent, frequent(docs, k, percent))), "led")
    total = F.col("n") + F.col("ln")
    least = F.ceil(F.lit(percent) * total / F.lit(100 + percent))
    near = members.where((F.col("pos") + F.col("lpos") <= total - 2 * least) & (F.least("n", "ln") >= least))
    stars = near.groupBy(F.col("lfp").alias("afp"), F.col("ln").alias("an"), F.col("fp").alias("bfp"), F.col("n").alias("bn")).agg(F.count("*").alias("lists"))
    stars = common.written(stars, "stars")
    # each set with the leader that it meets in most lists
    best = stars.groupBy("bfp").agg(F.max(F.struct("lists", "afp", "an", "bn")).alias("of")).select("of.afp", "of.an", "bfp", "of.bn")
    done = common.written(best, "best")
    first = links(done, rows, docs, k, percent)
    roots = common.written(common.components(_edges(first)), "roots")
    briefs = rows.where("n > 0").select("fp", "brief").dropDuplicates(["fp"])
    # then each with a few neighbours in its lists, so that large groups grow together; then all pairs still open
    done = _sorted(done)
    for nearest in (NEAREST, None):
        open_pairs = _open(members, briefs, first, roots.select(F.col("node").alias("fp"), "root"), percent, nearest)
        still = open_pairs.union(_between(_sorted(stars), roots)).distinct().join(done, ["afp", "bfp"], "left_anti").select("afp", "an", "bfp", "bn")
        still = common.written(still, "open")
        more = links(still, rows, docs, k, percent)
        if not more.isEmpty():
            roots = common.written(common.components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(_edges(more))), "roots")
        done = done.union(still)
    rows = rows.drop("bits", "brief").join(common.sized(roots.select(F.col("node").alias("fp"), "root")), "fp", "left")
    rows = common.written(rows.withColumn("root", F.coalesce("root", "fp")), "rooted")
    grouped = rows.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("first"), F.count("*").alias("size"))
    # a component of one row needs no join
    grouped = common.written(grouped.where("size > 1").drop("size"), "grouped")
    out = rows.join(common.sized(grouped), "root", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("first", "doc_id")).alias("component_id"))


def _sorted(pairs: DataFrame) -> DataFrame:
    swap = F.col("bfp") < F.col("afp")
    return pairs.select(
        F.least("afp", "bfp").alias("afp"), F.when(swap, F.col("bn")).otherwise(F.col("an")).alias("an"),
        F.greatest("afp", "bfp").alias("bfp"), F.when(swap, F.col("an")).otherwise(F.col("bn")).alias("bn"),
    )


def _between(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose sets are in different components."""
    root = common.sized(roots)
    for name in ("a", "b"):
        pairs = pairs.join(root.select(F.col("node").alias(f"{name}fp"), F.col("root").alias(f"{name}root")), f"{name}fp", "left")
    return pairs.where(F.coalesce("aroot", "afp") != F.coalesce("broot", "bfp")).select("afp", "an", "bfp", "bn")


def _edges(found: DataFrame) -> DataFrame:
    return found.select(F.col("afp").alias("a"), F.col("bfp").alias("b"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(common.table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the one with the smallest id."""
    gone = common.written(similar(docs).where("component_id <> doc_id").select("doc_id"), "gone")
    return common.with_ids(docs, gone, "doc_id", "left_anti")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) END AS sh
  FROM w
), t AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM t a JOIN t b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x
)
SELECT s.doc_id, len(s.sh) AS n_shingles, min(r.y) AS component_id FROM s JOIN r ON s.doc_id = r.x GROUP BY s.doc_id, s.sh
"""
