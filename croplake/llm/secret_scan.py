"""Secrets in text, told apart by how widely a value is owned over the whole corpus.

A scan finds spans by three patterns. Values are hashed where they are found and only hashes travel. Their owners and
repositories are counted once each over all documents. A value that ``SHARED_OWNERS`` or more owners have, or that is
in ``SHARED_REPOSITORIES`` or more repositories whoever owns them, is an example that is copied around: its spans get a
span ``shared``. A value of fewer that looks live (long enough, and of many different characters) gets a span
``owned``. Both counts are in the result for each base span.

Null texts count as empty. Documents without spans are in the result with counts of 0. A null owner is an owner.
Repeated rows are repeated in the result. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# The three patterns, with the group that is the value and the least length that counts.
PATTERNS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),  # a run of fewer fails anyway
)
#: A value of so many owners is shared; entropy in bits a character and length from which a value looks live.
SHARED_OWNERS, LIVE_BITS, LIVE_LENGTH = 3, 2.5, 8
#: A value in so many repositories is shared as well.
SHARED_REPOSITORIES = 4
#: Two keywords' letters decide whether the first pattern can match at all.
_WORDS = re.compile(r"passw|secret|token|api_?key", re.ASCII | re.IGNORECASE)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, number of the kind, end, value), ordered."""
    out = []
    for kind, (_, pattern, group, least) in enumerate(PATTERNS):
        if kind == 0 and not _WORDS.search(text):
            continue
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), kind, m.end(), m[group]))
    return sorted(out)


def looks_live(value: str) -> bool:
    counts = Counter(value)
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    return len(value) >= LIVE_LENGTH and bits >= LIVE_BITS


def _value_hash(value: str) -> bytes:
    return hashlib.sha256(value.encode()).digest()[:16]


_SCAN = "doc_id long, owner string, repository string, n_assign long, n_access long, n_hex long, base_sha256 string, base string, places string, hashes binary"


def scanned(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """One row per document: counts, the base spans, and for each the place, hash and look of its value."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = []
            for text in common.as_text(batch.column("text")):
                found = base_spans(text.as_py())
                joined = ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b, _ in found)
                n = Counter(k for _, k, _, _ in found)
                places = ",".join(f"{b - len(v)}:{b}:{int(looks_live(v))}" for _, _, b, v in found)
                rows.append((n[0], n[1], n[2], hashlib.sha256(joined.encode()).hexdigest(), joined, places, b"".join(_value_hash(v) for *_, v in found)))
            if rows:
                columns = dict(zip(("n_assign", "n_access", "n_hex", "base_sha256", "base", "places", "hashes"), zip(*rows, strict=True), strict=True))
                yield columns | {c: batch.column(c) for c in ("doc_id", "owner", "repository")}

    return common.over_batches(docs.select("doc_id", F.col(owner).cast("string").alias("owner"), F.col(repository).cast("string").alias("repository"), "text"), _SCAN, work)


def owned(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_shared, n_owned and counts of every document.

    ``counts`` holds ``owners:repositories`` of the value of every base span, in order of these.
    """
    rows = common.written(scanned(docs, owner, repository), "scanned")
    each = _each(rows)
    counted = common.sized(common.written(_counted(each), "counted"))
    # the counts of a document's values, as one small list per document
    lists = each.select("doc_id", "hashes", "value").distinct().join(counted, "value").groupBy("doc_id", "hashes").agg(F.collect_list(F.struct("value", "owners", "repositories")).alias("known"))
    lists = lists.withColumnsRenamed({"doc_id": "of_doc", "hashes": "of_hashes"})
    out = rows.join(lists, rows["doc_id"].eqNullSafe(lists["of_doc"]) & (rows["hashes"] == lists["of_hashes"]), "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            spans, n_shared, n_owned, counts = [], [], [], []
            for base, places, hashes, values in zip(*(batch.column(c).to_pylist() for c in ("base", "places", "hashes", "known")), strict=True):
                known = {v["value"]: (v["owners"], v["repositories"]) for v in values or ()}
                found, own = [], []
                for i, (span, place) in enumerate(zip(base.split(","), places.split(","), strict=True) if base else ()):
                    kind, a, b = span.split(":")
                    found.append((int(a), [p[0] for p in PATTERNS].index(kind), int(b), kind))
                    start, end, live = map(int, place.split(":"))
                    owners, repositories = known[hashes[i * 16 : i * 16 + 16]]
                    own.append(f"{owners}:{repositories}")
                    if owners >= SHARED_OWNERS or repositories >= SHARED_REPOSITORIES:
                        found.append((start, 3, end, "shared"))
                    elif live:
                        found.append((start, 4, end, "owned"))
                found = sorted(set(found))
                spans.append(",".join(f"{kind}:{a}:{b}" for a, _, b, kind in found))
                n_shared.append(sum(f[1] == 3 for f in found))
                n_owned.append(sum(f[1] == 4 for f in found))
                counts.append(",".join(own))
            yield {c: batch.column(c) for c in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")} | {"spans": spans, "n_shared": n_shared, "n_owned": n_owned, "counts": counts}

    return common.over_batches(out.drop("of_doc", "of_hashes"), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_shared long, n_owned long, counts string", work)


def values(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """(value hash, owners, repositories) of every candidate value."""
    return _counted(_each(scanned(docs, owner, repository)))


def _each(rows: DataFrame) -> DataFrame:
    """(doc_id, owner, repository, hashes, value) of every value of :func:`scanned`."""
    each = rows.where("base <> ''").select("doc_id", "owner", "repository", F.expr("explode(sequence(0, cast(length(hashes) div 16 - 1 AS int)))").alias("i"), "hashes")
    return each.select("doc_id", "owner", "repository", "hashes", F.expr("substring(hashes, i * 16 + 1, 16)").alias("value"))


def _counted(each: DataFrame) -> DataFrame:
    # one row per value, owner and repository before anything is counted, in every task before the shuffle
    owners = each.select("value", "owner", "repository").distinct().groupBy("value", "owner").agg(F.count("*").alias("repositories"))
    return owners.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "source", F.concat_ws("/", "source", "lang").alias("repository"))
    return owned(docs, "source", "repository")
