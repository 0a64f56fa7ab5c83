"""Vector codes, filter audit and suffix dedup against brute force, with nulls, ties, repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest

from croplake.llm import codebook, common, cover_sort, filter_audit

SF = "/root/testdata/sf0.001"


# --- vector codes -------------------------------------------------------------------------------------------


def plain_codes(rows, positions, entries, rounds):
    """(vec_id, label, codes, error) of ``rows(vec_id, vector, label)`` in order, by loops over lists."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(kept[0][1]) // positions
    part = [[v[p * width : (p + 1) * width] for p in range(positions)] for _, v, _ in kept]
    book = [[part[e][p] for e in range(min(entries, len(kept)))] for p in range(positions)]

    def assign():
        return [[min(range(len(book[p])), key=lambda e: (sum((a - b) ** 2 for a, b in zip(x[p], book[p][e])), e)) for p in range(positions)] for x in part]

    for _ in range(rounds):
        now = assign()
        for p in range(positions):
            for e in range(len(book[p])):
                mine = [x[p] for x, c in zip(part, now) if c[p] == e]
                if mine:
                    book[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    codes = assign()
    errors = [sum(sum((a - b) ** 2 for a, b in zip(x[p], book[p][c[p]])) for p in range(positions)) for x, c in zip(part, codes)]
    return [(i, label, c, e) for (i, _, label), c, e in zip(kept, codes, errors)], book


VECTOR = "vec_id long, embedding array<float>, label int, row long, salt long, part string, error long, of int"


def vector_rows(n, width, seed):
    r = random.Random(seed)
    rows = [(i, [r.choice([-2.5, -0.001, 0.0, 0.3, 7.25]) + r.randrange(4) / 8 for _ in range(width)], r.choice([None, 1, 2])) for i in range(n)]
    return rows


@pytest.mark.parametrize("rounds", [0, 1, 2, 4])
def test_codes_equal_plain_rounds(spark, monkeypatch, rounds):
    monkeypatch.setattr(codebook, "OWNER_ROWS", 40)
    rows = vector_rows(150, 8, 5)
    rows += [(150, rows[3][1], 1), (150, rows[3][1], 1), (7, rows[9][1], None), (None, rows[1][1], 2)] + [(200 + k, rows[0][1], 1) for k in range(60)]
    bad = [(900, None, 1), (901, [None] * 8, 1), (902, [float("nan")] * 8, 2), (903, [math.inf] + [0.0] * 7, 2), (904, [], 1), (905, [1.0] * 7, 1), (906, [1.0] * 16, 1)]
    df = spark.createDataFrame([(*r, 1, 2, "x", 3, 4) for r in rows + bad], VECTOR).repartition(5)
    codes, book = codebook.compress(df, positions=4, entries=16, rounds=rounds)
    want, plain_book = plain_codes(rows, 4, 16, rounds)
    assert book.tolist() == plain_book
    assert sorted(map(repr, map(tuple, codes.collect()))) == sorted(map(repr, want))


def test_only_changing_parts_migrate(spark):
    rows = vector_rows(120, 8, 9)
    df = spark.createDataFrame([(*r, 1, 2, "x", 3, 4) for r in rows], VECTOR)
    found = codebook.whole(df, 4)
    first = codebook.start(found, 4, 16)
    members = codebook.dealt(found, first, 2)
    second = codebook.updated(first, codebook.sums(members, []))
    gone = codebook.moved(members, [second]).count()
    stay = {(r["position"], r["entry"]) for r in codebook.sums(members, [second]).collect()}
    before = {(r["row"], r["position"]): r["entry"] for r in members.collect()}
    after = {(r["row"], r["position"]): r["entry"] for r in codebook._final(members, [second]).collect()}
    assert before.keys() == after.keys() and gone == sum(before[k] != after[k] for k in before) and 0 < gone < len(before)
    assert stay == {(p, after[r, p]) for r, p in before if before[r, p] == after[r, p]}


def test_codes_of_few_and_no_vectors(spark):
    few = spark.createDataFrame([(3, [0.5, 1e30], 1, *[0] * 2, "", 0, 0), (1, [-0.5, -1e30], None, *[0] * 2, "", 0, 0)], VECTOR)
    codes, book = codebook.compress(few, positions=2)
    assert book.shape == (2, 2, 1) and {r["error"] for r in codes.collect()} == {0}
    codes, book = codebook.compress(few.limit(0))
    assert codes.count() == 0 and not book.size


# --- filter audit -------------------------------------------------------------------------------------------


def plain_mask(i, text, rows):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    smaller = any((u or "") == text and ((j is not None and i is None) or (j is not None and i is not None and j < i)) for j, u, *_ in rows)
    fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search("[#$%&*|]", text)), smaller]
    return {f for f, x in zip("ABCDE", fails) if x}


def test_audit_equals_loops_over_orders(spark):
    long, dull = " ".join(f"w{i}" for i in range(230)), "same same " * 150
    texts = [None, "", " \n ", "Some TEXT", "a # b", long, long + "#", dull, dull + " A" * 40, "é" * 300, long.upper(), "\x0b\x1fx\xa0y", long]
    rows = [(i, t, [None, "en", "de", ""][i % 4]) for i, t in enumerate(texts * 2)]
    rows += [(5, long, "en"), (5, long, "de"), (None, long, "en"), (None, long, None), (None, "alone", None)]
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 20)] + [(5, 0, 1), (None, 1, 1), (6, None, None), (7, 1, None)]
    docs = spark.createDataFrame([(*r, "m", 1, 0, "s") for r in rows], "doc_id long, text string, lang string, part string, n int, mask int, sha string").repartition(3)
    marks = spark.createDataFrame([(*r, "p") for r in labels], "doc_id long, quality int, toxic int, part string")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in filter_audit.audit(filter_audit.masked(docs, marks), "ABCDE").collect()}
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    found = [(lang or "", i, plain_mask(i, t, rows)) for i, t, lang in rows]
    want, shapley = {}, {}
    for part in {p for p, *_ in found}:
        mine = [(i, m) for p, i, m in found if p == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            for k, f in enumerate(order):
                before = set(order[:k])
                here = [i for i, m in mine if f in m and not m & before]
                want[part, order, k + 1] = (
                    sum(not m & (before | {f}) for _, m in mine), len(here), sum(f in m and bool(m & before) for _, m in mine),
                    sum(m == {f} for _, m in mine), sum(i in good for i in here), sum(i in toxic for i in here),
                )
                shapley[part, f] = shapley.get((part, f), 0) + len(here)
    assert got == {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in want.items()}
    assert filter_audit.audit(filter_audit.masked(docs.limit(0), marks), "ABCDE").count() == 0


def test_path_counts():
    forward, backward = filter_audit.path_counts(4)
    assert forward[15] == backward[0] == 24
    for state in range(16):
        k = state.bit_count()
        assert forward[state] == math.factorial(k) and backward[state] == math.factorial(4 - k)
    assert sum(w for s, f, w in filter_audit.edges(4) if f == 2) == 24


# --- suffix dedup -------------------------------------------------------------------------------------------


def plain_cut(rows, length=100):
    """(doc_id, n_bytes, spans, digest) of rows in order of documents: every window in a dictionary of first places."""
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                gone[at : at + length] = [True] * length
            seen.add(window)
        turns = [k for k in range(len(data) + 1) if (k and gone[k - 1]) != (k < len(data) and gone[k])]
        spans = ",".join(f"{a}:{b}" for a, b in zip(turns[::2], turns[1::2]))
        out.append((i, len(data), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()))
    return out


def repeated_texts(n, seed):
    r = random.Random(seed)
    pool = ["".join(r.choice("ab cdé漢") for _ in range(r.randrange(40, 400))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randrange(0, 6)):
            p = r.choice(pool)
            a = r.randrange(0, 30)
            parts += [p[a : len(p) - r.randrange(0, 30)], "".join(r.choice("xyz") for _ in range(r.randrange(0, 80)))]
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup_equals_every_window(spark, monkeypatch, seed):
    monkeypatch.setattr(cover_sort, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(cover_sort, "PIECE", 701)
    monkeypatch.setattr(cover_sort, "BUCKET", 500)
    rows = repeated_texts(60, seed)
    rows += [(60, None), (61, ""), (62, "q" * 99), (63, "q" * 100), (64, "q" * 5000), (65, rows[7][1]), (66, rows[7][1]), (67, "é" * 60), (68, "aé" * 50 + "b"), (None, rows[3][1] + "tail" * 40)]
    df = spark.createDataFrame([(*r, 1, "k", 2, "t") for r in rows], "doc_id long, text string, block long, ids string, bytes long, texts string")
    df = df.repartition(4)
    want = plain_cut(rows)
    assert sum(bool(s) for _, _, s, _ in want) > 20
    assert sorted(map(repr, map(tuple, cover_sort.cut(df).collect()))) == sorted(map(repr, want))


def test_suffix_dedup_of_repeated_rows_and_none(spark):
    text = "".join(random.Random(4).choices("abcdefgh", k=5000))
    rows = [(1, text), (1, text), (1, text[:50]), (None, text), (None, None), (2, text[200:400] + "!" + text[:150])]
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["spans"]) for r in cover_sort.cut(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 0, ""), (0, 5000, "0:5000"), (1, 50, ""), (1, 5000, ""), (1, 5000, "0:5000"), (2, 351, "0:200,201:351")]
    kept = cover_sort.cut(spark.createDataFrame(rows, "doc_id long, text string"), texts=True).where("doc_id = 2").first()["kept"]
    assert bytes(kept) == b"!"
    assert cover_sort.cut(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_cover_and_packed_keys():
    assert {(a - b) % cover_sort.V for a in cover_sort.COVER for b in cover_sort.COVER} == set(range(cover_sort.V))
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    for x in (keys, keys[:0], keys[::-1], np.array([5, 5, 5], np.uint64)):
        assert (cover_sort.unpacked(cover_sort.packed(x)) == x).all()


def test_queries_read_whole_tables(spark):
    assert cover_sort.op13_suffix_dedup(spark, SF).count() == common.table(spark, SF, "documents").count()
