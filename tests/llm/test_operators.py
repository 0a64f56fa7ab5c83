"""Each operator against brute force on small rows with nulls, empty and repeated texts, ties and clashing columns."""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import difference, oracle_connection
from croplake.llm import common, decontaminate, exact, html_text, jaccard, language, mixing, queries, secret_scan, substring, toxicity, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score double, n int, fp string, root int"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
BASE = " ".join(f"alpha{i}" for i in range(60))
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE.replace("alpha7 ", "beta ")), (4, BASE.replace(" ", "  \t")), (5, None), (6, ""), (7, " \n "),
    (8, "one two"), (9, "One  TWO"), (10, LONG), (11, LONG + " tail end"), (12, "é ß 漢字"), (13, BASE + " " + BASE.replace("alpha", "gamma")),
    (14, BASE.replace("alpha7 ", "beta ").replace("alpha50 ", "x ")), (None, BASE), (None, None), (15, "one two"), (15, "one two"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if (i or 0) % 2 else None, [None, "a", "b", "c"][(i or 0) % 4], 1, "no", 0.5, 3, "f", 1) for i, t in TEXTS]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = oracle_connection(SF)
    assert difference(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name]) is None


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_filter_holds_its_keys():
    keys = pa.array(range(3000)).to_numpy().astype("uint64") * 7919
    built = exact.build_filter(keys)
    assert exact.may_hold(keys, *built).all()
    assert exact.may_hold(keys + 1, *built).mean() < 0.03


def test_exact_dedup(docs, empty):
    half = F.coalesce(F.col("doc_id"), F.lit(0)) % 3 == 1
    got = exact.dedup(docs.where(~half), docs.where(half)).collect()
    plain = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in TEXTS]
    want = []
    for i, t in plain:
        ids = [j for j, u in plain if u == t]
        keep = min((j for j in ids if j is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert exact.dedup(empty, empty).count() == 0
    stage = exact.stage(docs.sparkSession, docs, SF)
    assert stage.columns == docs.columns
    assert sorted(r["doc_id"] for r in stage.collect() if r["doc_id"]) == [1, 3, 5, 7, 8, 9, 10, 11, 12, 13, 14, 15, 15][:0] + sorted(i for i, k, *_ in want if i is not None and i == k)


def test_batches_share_the_filters_of_a_snapshot(docs, monkeypatch):
    """Two batches against one snapshot decide as each would alone, and build no filter."""
    third = F.coalesce(F.col("doc_id"), F.lit(0)) % 3
    kept = exact.snapshot_of(docs.where(third == 0))
    monkeypatch.setattr(exact, "filters", None)
    plain = lambda df: sorted(map(repr, map(tuple, df.collect())))
    got = [plain(exact.dedup(kept, docs.where(third == k))) for k in (1, 2)]
    monkeypatch.undo()
    assert got == [plain(exact.dedup(docs.where(third == 0), docs.where(third == k))) for k in (1, 2)]


def test_jaccard(docs, empty):
    got = sorted(map(repr, map(tuple, jaccard.similar(docs).collect())))
    sets = [shingles(t) for _, t in TEXTS]
    group = list(range(len(TEXTS)))
    for _ in TEXTS:
        for a, b in itertools.combinations(range(len(TEXTS)), 2):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
                group[a] = group[b] = min(group[a], group[b])
    want = []
    for at, (i, _) in enumerate(TEXTS):
        ids = [TEXTS[j][0] for j in range(len(TEXTS)) if group[j] == group[at] and TEXTS[j][0] is not None]
        want.append((i, len(sets[at]), i if not sets[at] else min(ids, default=None)))
    assert got == sorted(map(repr, want))
    assert jaccard.similar(empty).count() == 0


def test_jaccard_of_a_group_without_an_original(spark):
    """Variants that are all alike but for two words each, and a chain of ever further edits."""
    base = [f"t{i}" for i in range(80)]
    rows = []
    for i in range(40):
        w = list(base)
        w[(7 * i) % 80] = f"v{i}"
        w[(11 * i + 3) % 80] = f"u{i}"
        rows.append((i, " ".join(w)))
    w = [f"c{i}" for i in range(100)]
    for i in range(12):
        w[(8 * i) % 100] = f"z{i}"
        rows.append((100 + i, " ".join(w)))
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: shingles(t) for i, t in rows}
    group = {i: i for i in sets}
    for _ in range(60):
        for a, b in itertools.combinations(sets, 2):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group[a] = group[b] = min(group[a], group[b])
    assert got == group


def test_parity_bits_never_bound_too_low():
    import numpy as np

    random = np.random.default_rng(3)
    for n, m, both in ((5, 6, 3), (300, 260, 200), (3000, 2000, 1900)):
        pool = np.unique(random.integers(0, 1 << 63, 6000, dtype=np.uint64))
        a, b = pool[:n], pool[n - both : n - both + m]
        assert jaccard._apart(jaccard._bits(a), jaccard._bits(b)) <= n + m - 2 * both


def test_contained(spark, docs, empty):
    items = spark.createDataFrame([(1, BASE.upper()), (2, None), (3, ""), (4, "one two"), (5, " ".join(LONG.split()[300:330])), (6, "nothing of this kind is anywhere at all"), (7, BASE + " more words at the end that are not there at all so it fails yes it does fail")], "item_id long, text string")
    got = sorted(map(repr, [(r[0], r[1], r[2], r[3]) for r in decontaminate.contained(docs, items).collect()]))
    want = []
    for (i, t), item in itertools.product(TEXTS, items.collect()):
        a, b = shingles(t), shingles(item["text"])
        if b and 100 * len(a & b) >= 80 * len(b):
            want.append((i, item["item_id"], len(a & b), len(b)))
    assert got == sorted(map(repr, want))
    assert decontaminate.contained(empty, items).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == docs.count()
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect() if r["doc_id"]}.isdisjoint({w[0] for w in want})


def test_warc(spark, tmp_path):
    rows = [(1, "http://a/é x\r\n", "<p>hi</p>"), (2, None, "<p>hi</p>"), (3, "u", None), (4, "u", ""), (5, "u", "x" * 300_000 + "é"), (None, "n", "<p>hi</p>"), (6, "w", "WARC/1.1\r\n\r\n"), (7, "r", "same"), (7, "r", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    path = f"file://{tmp_path}/warc"
    got = warc.read(spark, path, warc.write(pages, path)).collect()
    assert len(got) == len(rows)
    for r in got:
        body = next((h or "").encode() for i, _, h in rows if i == r["page_id"])
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in got}
    assert {(2, "response", None), (1, "revisit", 2), (None, "revisit", 2), (4, "response", None), (3, "revisit", 4), (7, "response", None), (7, "revisit", 7)} <= kinds
    assert all(r["record_type"] == "response" for r in warc.read(spark, path + "2", warc.write(pages, path + "2", least=1_000_000)).collect())
    assert warc.read(spark, path + "3", warc.write(pages.limit(0), path + "3")).count() == 0


def test_secrets(spark, empty):
    key = "AKIA" + "ABCDEFGHIJKLMNOP"
    rows = [(1, 'é password = "hunter2xyz9Q" and token=ab', "a"), (2, f"x {key} y API-KEY:1 apikey : abcdefgh", "b"), (3, "deadbeef" * 4, "a"), (4, "secret=shared123456", "a"), (5, "secret=shared123456", "b"), (6, "SECRET: shared123456", "c"), (7, None, None), (8, "", "x"), (9, "api_key=token : abcdef", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("owner", F.lit(1))
    got = {r["doc_id"]: r for r in secret_scan.owned(docs, "source", "source").collect()}
    for i, text, _ in rows:
        found = []
        for order, (kind, pattern, group, least) in enumerate((
            ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24),
        )):
            found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
        joined = ",".join(x for *_, x in sorted(found))
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), text
        assert set(joined.split(",")) - {""} <= set(got[i]["spans"].split(","))
    assert "shared:7:19" in got[4]["spans"] and "shared" not in got[1]["spans"] and "owned" in got[1]["spans"]
    assert secret_scan.owned(empty, "source", "source").count() == 0


def test_secrets_shared_by_repositories(spark):
    """A value in many repositories of few owners is an example; one in few repositories isn't, however often it stands there."""
    rows = [(i, "secret=copied987654", "a", f"a/{i}") for i in range(4)] + [(10 + i, "token=mine1234567 token=mine1234567", "a", "a/1") for i in range(9)]
    rows += [(20 + i, "passwd=twoOwners4567", "ab"[i % 2], f"{'ab'[i % 2]}/{i // 2}") for i in range(4)] + [(30 + i, "secret=three123456", "a", f"a/{i}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, repository string")
    got = {r["doc_id"]: r for r in secret_scan.owned(docs, "source", "repository").collect()}
    assert [(got[i]["n_shared"], got[i]["n_owned"], got[i]["counts"]) for i in (0, 10, 20, 30)] == [(1, 0, "1:4"), (0, 2, "1:1,1:1"), (1, 0, "2:4"), (0, 1, "1:3")]


def plain_units(text):
    """(start, end, whole line?, what makes it equal to others) of every unit, by the rules in words."""
    text = text or ""
    bounds, at = [], 0
    for m in re.finditer(r"[.!?]+[\x20\x09\x0B-\x0D]+|\n+|$", text):
        if m.end() == at:
            continue
        own = words(text[at : m.end()])
        cut = at
        if len(own) > 32:
            for w in re.finditer(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text[at : m.end()]):
                if zlib.crc32(words(w[0])[0].encode()) % 16 == 0 and at + w.end() < m.end():
                    bounds.append((cut, at + w.end()))
                    cut = at + w.end()
        bounds.append((cut, m.end()))
        at = m.end()
    bounds = [(a, b) for a, b in bounds if words(text[a:b])]
    lines: dict[int, list[int]] = {}
    for k, (a, _) in enumerate(bounds):
        lines.setdefault(text.rfind("\n", 0, a) + 1, []).append(k)
    for mine in lines.values():
        a, b = bounds[mine[0]][0], bounds[mine[-1]][1]
        yield a, b, True, ("", tuple(words(text[a:b])))
        for k in mine if len(mine) > 1 else []:
            a, b = bounds[k]
            own = words(text[a:b])
            if len(own) >= 10:
                yield a, b, False, ("", tuple(own))
                continue
            for mark, step in (("<", -1), (">", 1)):
                taken, j = list(own), k
                while len(taken) < 10 and 0 <= j + step < len(bounds):
                    j += step
                    more = words(text[slice(*bounds[j])])
                    taken = more + taken if step < 0 else taken + more
                if len(taken) >= 10:
                    yield a, b, False, (f"{mark}{len(own)}", tuple(taken))
                    break


def plain_repeats(rows):
    """(doc_id, removed offsets) and the keeper of every removed unit, by dictionaries."""
    place = lambda d, s: (d is None, d or 0, s)
    first = {}
    for d, t in rows:
        for s, _, _, what in plain_units(t):
            first[what] = min(first.get(what, place(None, 1 << 60)), place(d, s))
    out = {}
    for d, t in rows:
        found = [(s, e, whole, first[what]) for s, e, whole, what in plain_units(t) if first[what] != place(d, s)]
        gone = [(s, e) for s, e, whole, _ in found if whole]
        kept = {}
        for s, e, whole, keeper in found:
            if whole or not any(a <= s < b for a, b in gone):
                kept[s, e] = min(kept.get((s, e), keeper), keeper)
        runs = []
        for (s, e), keeper in sorted(kept.items()):
            if runs and runs[-1][1] == s and runs[-1][2][:2] == keeper[:2] and runs[-1][2][2] - runs[-1][0] == keeper[2] - s:
                runs[-1][1] = e
            else:
                runs.append([s, e, keeper])
        out[d, t] = [(d, s, e, None if k[0] else k[1], k[2]) for s, e, k in runs]
    return out


def test_substring(spark, empty):
    """Lines, sentences, pieces of text without sentence ends, with context before and after, against plain rules."""
    import random

    r = random.Random(8)
    passage = "This passage of more than ten words is shared by several documents. It goes on. Short one! For another sentence that is long as well, and so it goes. And ends."
    endless = " ".join(f"word{r.randrange(400)}" for _ in range(70))
    rows = [(1, "Own words first of all here. " + passage + " Then more."), (2, "Another start.\n" + passage), (3, "short line\nshort line"), (4, None), (5, ""), (5, ""), (None, passage), (6, passage + "\n" + passage)]
    rows += [(7, "x1 x2 x3 " + endless + " y1 y2"), (8, endless[20:] + " z"), (9, "One. Two. Three.  Four five six seven eight nine ten. " + passage), (9, "Other text of the same id. " + passage), (10, "\n\n É É \x1f \xa0 \n"), (11, "é é \x1f \xa0")]
    for i in range(20, 60):
        rows.append((i, "".join(r.choice([passage[:80], passage[30:], endless[: r.randrange(100, 400)], "a. ", "b\n", "Some words here. "]) + r.choice([" ", ". ", "\n"]) for _ in range(5))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit(1)).withColumn("line", F.lit(1)).withColumn("key", F.lit("k"))
    got = substring.repeated(docs)
    want = sorted(repr(x) for found in plain_repeats(rows).values() for x in found)
    assert sorted(repr((x["doc_id"], x["start"], x["end"], x["keep_doc_id"], x["keep_start"])) for x in got.collect()) == want and len(want) > 40
    left = {(x["doc_id"], x["removed"]): x["text"] for x in substring.cleaned(docs, got).collect()}
    for (d, t), found in plain_repeats(rows).items():
        kept, at = "", 0
        for _, a, b, _, _ in found:
            kept, at = kept + (t or "")[at:a], b
        assert (left[d, ",".join(f"{a}:{b}" for _, a, b, _, _ in found)] or "") == kept + (t or "")[at:]
    assert substring.repeated(empty).count() == 0


def test_substring_finds_passages(spark):
    """A passage of 51 words, wherever it is cut out and whatever stands around it, goes for the most part."""
    import random

    r = random.Random(5)
    text = " ".join(f"w{r.randrange(900)}" + r.choice(["", "", "", "", "", ".", ","]) for _ in range(3000))
    every = text.split(" ")
    rows, share = [(0, text)], []
    for i in range(1, 60):
        a = r.randrange(0, 2900)
        rows.append((i, " ".join([*(f"own{r.randrange(10**6)}" for _ in range(30)), *every[a : a + 51], *(f"own{r.randrange(10**6)}" for _ in range(30))])))
    for x in substring.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        share.append((x["doc_id"], x["end"] - x["start"]))
    found = {d: sum(n for e, n in share if e == d) for d, _ in share}
    assert len(found) >= 57 and sum(found.values()) > 0.5 * 59 * 51 * 4


def test_substring_of_short_lines(spark, empty):
    """Every line that stands earlier goes, however short and whatever comes before it; first lines stay."""
    rows = [(1, "Alpha beta\none"), (2, "two\nalpha  BETA\n\nthree"), (3, "one"), (4, "\u6f22\u5b57"), (5, "\u6f22\u5b57\nfour"), (None, "four"), (6, None), (7, "\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring.repeated(docs)
    left = {r["doc_id"]: r["text"] for r in substring.cleaned(docs, got).collect()}
    assert left[1] == "Alpha beta\none" and left[2] == "two\nthree" and left[3] == left[None] == "" and left[5] == "four" and left[4] == "\u6f22\u5b57"
    assert sorted((r["doc_id"] or 0, r["start"], r["end"], r["keep_doc_id"], r["keep_start"]) for r in got.collect()) == [(0, 0, 4, 5, 3), (2, 4, 17, 1, 0), (3, 0, 3, 1, 11), (5, 0, 3, 4, 0)]


def test_mixing(docs, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == len(TEXTS)
    assert sorted(r["size"] for r in got) == sorted(len(words(t)) for _, t in TEXTS)
    assert all(r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in got)
    sources = {r["source"]: r for r in got}
    assert abs(sum(r["target"] for r in sources.values()) - 1.5 * sum(r["source_size"] for r in sources.values())) < 1e-6
    for name, r in sources.items():
        own = [x for x in got if x["source"] == name]
        assert r["target"] <= 2 * r["source_size"] + 1e-9
        assert abs(sum(x["taken"] for x in own) - r["target"]) <= max(x["size"] for x in own)
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs.repartition(7)).collect()))
    assert mixing.mix(empty).count() == 0


def test_mixing_follows_expectation(spark):
    """Many chunks, several levels: sums are kept and copies are fair."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 17 + 1).cast("int")).alias("text"))
    got = mixing.mix(docs).toPandas()
    assert len(got) == 3000 and got.doc_id.nunique() == 3000
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), copies=("copies", "mean"), size=("source_size", "first"))
    assert ((by.taken - by.target).abs() <= 17).all()
    assert ((by.copies - by.target / by["size"]).abs() < 0.1).all()


def test_mixing_of_many_equal_rows(spark):
    """Rows of one id, and rows without an id, of one size: each a document of its own, in many chunks; reruns agree."""
    rows = spark.range(9000).select(
        F.when(F.col("id") < 4000, F.lit(5)).when(F.col("id") < 8000, F.lit(None)).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.lit("one two three").alias("text"),
    )
    got = mixing.mix(rows).toPandas()
    assert len(got) == 9000 and got.doc_id.isna().sum() == 4000 and (got.doc_id == 5).sum() == 4000
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((by.taken - by.target).abs() <= 3).all()
    again = mixing.mix(rows.repartition(5)).toPandas()
    same = [sorted(zip(x.doc_id.fillna(-1), x.source, x.taken)) for x in (got, again)]
    assert same[0] == same[1]


@pytest.mark.parametrize("sizes", [[7], [10, 10, 10], [1, 500, 3, 4, 90], [0, 0], [0, 8, 2, 100, 100, 5, 5, 5]])
def test_mixing_targets_equal_a_plain_reshare(spark, sizes):
    """Shares by weight; what is over a cap goes to the others by weight, again and again."""
    names = [*(f"s{k}" for k in range(len(sizes) - 1)), None]
    rows = [(k, name, "w " * n) for k, (name, n) in enumerate(zip(names, sizes))]
    got = {r["source"]: r["target"] for r in mixing.targets(mixing.sizes(spark.createDataFrame(rows, "doc_id long, source string, text string"))).collect()}
    weight = {n: (5, 2, 1)[k % 3] for k, n in enumerate(names)}
    size, left, full = dict(zip(names, sizes)), 1.5 * sum(sizes), {}
    while True:
        free = [n for n in names if n not in full]
        total = sum(weight[n] for n in free)
        over = [n for n in free if left * weight[n] / total > 2 * size[n]]
        if not over:
            want = full | {n: left * weight[n] / total for n in free}
            break
        for n in over:
            full[n] = 2 * size[n]
        left = 1.5 * sum(sizes) - sum(full.values())
    assert got.keys() == want.keys() and all(abs(got[n] - want[n]) < 1e-6 for n in want)


def test_toxicity(spark, empty):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    labels = common.table(spark, "/root/testdata/sf0.01", "labels")
    got = toxicity.scored(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.predicted == (held.score >= 0.7)).all()
    assert (held.held_out == held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    assert held[(held.toxic == 0)].predicted.mean() < 0.02
    toxic, other = held[held.toxic == 1].score, held[held.toxic == 0].score
    assert sum((toxic > s).sum() for s in other) / (len(toxic) * len(other)) > 0.7
    none = toxicity.scored(docs.limit(5), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert toxicity.scored(empty, labels).count() == 0


def test_fit_equals_a_plain_ftrl():
    """Per-coordinate steps with L1, by dictionaries, over the same features and order of texts."""
    import math
    import random

    import numpy as np

    r = random.Random(3)
    bad, good = ["vile", "hate", "awful"], ["tree", "house", "river", "cloud", "stone"]
    texts = [" ".join(r.choice(good + bad * (i % 3 == 0)) for _ in range(12)) for i in range(60)] + ["", "one"]
    labels = np.array([1 if i % 3 == 0 else 0 for i in range(62)])
    each = [set(map(int, f)) for f in toxicity._each(pa.array(texts))]
    count: dict[int, int] = {}
    for found in each:
        for f in found:
            count[f & int(toxicity._SKETCH)] = count.get(f & int(toxicity._SKETCH), 0) + 1
    rows = [[0, *sorted(f for f in found if count[f & int(toxicity._SKETCH)] >= toxicity.LEAST_TEXTS)] for found in each]
    z: dict[int, float] = {}
    n: dict[int, float] = {}
    l1 = min(toxicity.L1_MOST, toxicity.L1_LEAST + toxicity.L1_PER_TEXT * int(labels.sum()))

    def weight(f):
        over = abs(z.get(f, 0.0)) - l1
        return -math.copysign(over, z[f]) / ((toxicity.BETA + math.sqrt(n[f])) / toxicity.ALPHA + toxicity.L2) if over > 0 else 0.0

    for epoch in range(toxicity.EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            now = {f: weight(f) for f in rows[i]}
            g = 1 / (1 + math.exp(-sum(now.values()))) - labels[i]
            for f in rows[i]:
                before = n.get(f, 0.0)
                n[f] = before + g * g
                z[f] = z.get(f, 0.0) + g - (math.sqrt(n[f]) - math.sqrt(before)) / toxicity.ALPHA * now[f]
    want = {f: weight(f) for f in z if weight(f)}
    names, weights = toxicity.fit(pa.array(texts), labels)
    got = dict(zip(map(int, names), weights))
    assert got.keys() == want.keys() and len(want) > 5 and all(math.isclose(got[f], want[f], rel_tol=1e-9, abs_tol=1e-9) for f in want)


def test_toxicity_of_odd_rows(spark, monkeypatch):
    """Nulls, a null id, repeated rows and labels, a very long text, clashing columns; the sample keeps to its bytes."""
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 5000)
    rows = [(i, ("you vile fool " if i % 4 == 0 else "a tree by the house ") * 8) for i in range(200)]
    rows += [(None, "vile fool"), (300, None), (300, None), (301, ""), (302, "tree house " * 100_000), (3, rows[3][1])]
    docs = spark.createDataFrame([(*x, 1.0, True, 5) for x in rows], "doc_id long, text string, score double, held_out boolean, toxic int").repartition(3)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)] + [(4, 0, 0), (None, 1, 1), (302, 1, 0), (5, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    place = lambda i: -1 if i is None else i
    assert sorted((place(r["doc_id"]), r["held_out"]) for r in got) == sorted((place(i), i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in rows)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 200]
    assert min(r["score"] for r in held if r["doc_id"] % 4 == 0) > max(r["score"] for r in held if r["doc_id"] % 4)


def test_language(spark, docs, empty):
    table = common.table(spark, "/root/testdata/sf0.01", "documents")
    got = language.identified(table).join(table.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.95
    assert got.score.between(0, 1).all()
    odd = {r["doc_id"]: r for r in language.identified(docs).collect()}
    assert odd[5]["lang_pred"] == odd[6]["lang_pred"] == "und" and odd[6]["score"] == 0.0
    assert len(language.identified(docs).collect()) == len(TEXTS)
    assert language.identified(empty).count() == 0


def test_forward_backward_is_exact():
    import numpy as np

    random = np.random.default_rng(5)
    e, switch = random.normal(size=(1, 4, 3)), random.normal(size=(3, 3))
    gamma, pairs = language.marginals(e, np.array([4]), switch)
    want, total = np.zeros((4, 3)), 0.0
    for path in itertools.product(range(3), repeat=4):
        p = np.exp(sum(e[0, t, y] for t, y in enumerate(path)) + sum(switch[a, b] for a, b in itertools.pairwise(path)))
        total += p
        for t, y in enumerate(path):
            want[t, y] += p
    assert np.allclose(gamma[0], want / total) and np.isclose(pairs.sum(), 3)
    assert np.allclose(language._word_marginals(e, np.array([4]), switch)[0], want / total)


def test_messages_pass_between_pieces():
    """Texts cut to pieces of 64 words are labelled as one chain each."""
    import numpy as np

    random = np.random.default_rng(6)
    langs, lengths = 4, [1, 64, 65, 128, 300, 7]
    switch = random.normal(size=(langs, langs))
    scores = [random.normal(size=(n, langs)) * 0.3 for n in lengths]
    pieces, sizes, text = [], [], []
    for k, s in enumerate(scores):
        for at in range(0, len(s), 64):
            piece = np.zeros((64, langs))
            piece[: len(s[at : at + 64])] = s[at : at + 64]
            pieces.append(piece)
            sizes.append(len(s[at : at + 64]))
            text.append(k)
    got = language._word_marginals(np.stack(pieces), np.array(sizes), switch, np.array(text))
    for k, s in enumerate(scores):
        want, _ = language.marginals(s[None], np.array([len(s)]), switch)
        mine = np.concatenate([got[i, : sizes[i]] for i in range(len(sizes)) if text[i] == k])
        assert np.allclose(mine, want[0])


def test_languages_of_mixed_text(spark):
    """Spans of a text that changes its language, with places in the text as it is."""
    table = common.table(spark, "/root/testdata/sf0.01", "documents")
    rows = {r["lang"]: r["text"] for r in table.where("lang in ('en', 'de') and length(text) between 400 and 3000").orderBy("doc_id").collect()}
    english, german = rows["en"][:300].strip(), rows["de"][:300].strip()
    mixed = spark.createDataFrame([(-1, f"\u0130 {english} {german}"), (-2, " 1 2 \u2014 "), (None, None)], "doc_id long, text string")
    all_rows = table.select("doc_id", "text", "lang").union(mixed.withColumn("lang", F.lit(None).cast("string")))
    got = language.labelled(all_rows).where("doc_id < 0 or doc_id is null").orderBy("start").collect()
    assert {r["doc_id"] for r in got} == {-1}
    text = f"\u0130 {english} {german}"
    middle = len(english) + 3
    bounds = {"en": (0, middle), "de": (middle, len(text))}
    part = {lang: sum(max(0, min(r["end"], z) - max(r["start"], a)) for r in got if r["lang"] == lang) for lang, (a, z) in bounds.items()}
    assert part["en"] > 0.7 * len(english) and part["de"] > 0.7 * len(german) and max(r["end"] for r in got) <= len(text)
    assert all(a["end"] <= b["start"] for a, b in zip(got, got[1:]))


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body><header>Site <a href=x>Home</a></header>
<nav><ul><li><a href="/a">A</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Title &amp; more</h1><p>First&nbsp; <b>bold</b><br>line<p>Second</p><ul><li>one<li>two</ul>
<div class="ad">Buy the thing of the year</div><section id="comments"><p>Nice one</p></section><footer>By me</footer></article>
<aside>Other</aside><footer>&copy; x</footer>"""


def test_html(spark):
    want = "Title & more\n\nFirst bold line\n\nSecond\n\none\n\ntwo"
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p>unclosed <a title='x>y' href=z>link</a> &lt;b&gt; &#39;"), (None, "u", "<!-- never closed <p>x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {r["page_id"]: r for r in html_text.extracted(pages).collect()}
    assert got[1]["text"] == want and got[1]["n_chars"] == len(want)
    assert got[2]["text"] == got[3]["text"] == got[None]["text"] == ""
    assert got[4]["text"] == "unclosed link <b> '"
    assert html_text.extracted(pages.limit(0)).count() == 0


def test_html_rules_without_an_article():
    text = "The rules of the second pass give the label of the nearest block that is decided, and this is a long block of text that has the words for it. "
    page = f"<div><a href=a>one</a> <a href=b>two</a></div><p>{text * 2}</p><p>Short one.</p><p>{text * 2}</p><div><a href=c>three</a></div>"
    assert html_text.main_text(page) == f"{(text * 2).strip()}\n\nShort one.\n\n{(text * 2).strip()}"


def test_html_rules_within_and_outside_an_article():
    text = "The rules of the second pass give the label of the nearest block that is decided, and this is a long block of text that has the words for it. "
    lists = "".join(f"<li><a href={i}>Another page {i}</a></li>" for i in range(6))
    page = f"<p>Short line</p><article><h1><a href=x>Title</a></h1><p>{text}</p><ul>{lists}</ul><p>{text}</p><p>Short end.</p></article><div><h2>Part two</h2><p>{text * 2}</p></div><p>Track list one</p><p>Track list two</p>"
    good = text.strip()
    assert html_text.main_text(page) == f"Title\n\n{good}\n\n{good}\n\nShort end.\n\nPart two\n\n{(text * 2).strip()}\n\nTrack list one"


@pytest.mark.parametrize("text", [
    "Drzewa rosną wolno, lecz każdej wiosny przybywa im liści, które jesienią spadają na ziemię i karmią glebę przez całą zimę.",
    "Gli alberi crescono piano, ma ogni primavera hanno foglie nuove che in autunno cadono a terra e nutrono il suolo per tutto l'inverno.",
    "Деревья растут медленно, но каждую весну у них появляются новые листья, которые осенью падают на землю и питают почву.",
    "树木生长缓慢，但每年春天都会长出新叶，秋天落到地上，在整个冬天滋养土壤，直到来年春天再次发芽。",
])
def test_html_of_a_language_without_listed_words(text):
    menu = "".join(f"<div><a href={i}>x{i}</a></div>" for i in range(3))
    assert html_text.main_text(f"{menu}<h2>T</h2><p>{text}</p><p>{text}</p>{menu}") == f"T\n\n{text}\n\n{text}"


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 6), (9, 9), (3, 1), (6, 7), (7, 8), (-4, 8)] + [(100, i) for i in range(101, 400)] + [(i, i + 1) for i in range(500, 560)]
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {n: got[n] for n in (1, 2, 3, 5, 6, 7, 8, -4)} == {1: 1, 2: 1, 3: 1, 5: -4, 6: -4, 7: -4, 8: -4, -4: -4}
    assert all(got[i] == 100 for i in range(100, 400)) and all(got[i] == 500 for i in range(500, 561))
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
