"""The pipeline's stages against what each must keep and drop of its own input."""

from __future__ import annotations

import corpus_pipeline
from croplake.llm import common

SF = "/root/testdata/sf0.01"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard", "decontamination", "mixing"]


def test_run(spark):
    from test_operators import shingles

    docs = common.table(spark, SF, "documents")
    texts, now = {r["doc_id"]: r["text"] for r in docs.collect()}, docs
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = common.written(stage(spark, now, SF), "test")
        assert now.columns == docs.columns
        seen.append({r["doc_id"] for r in now.select("doc_id").collect()})
    assert all(b <= a for a, b in zip(seen, seen[1:]))
    plain = {i: " ".join((texts[i] or "").split()) for i in seen[0]}
    assert seen[1] == {min(i for i in plain if plain[i] == t) for t in set(plain.values())}
    items = [shingles(r["text"]) for r in common.table(spark, SF, "benchmark").collect()]
    leaks = {i for i in seen[2] if any(x and 100 * len(x & shingles(texts[i])) >= 80 * len(x) for x in items)}
    assert seen[3] == seen[2] - leaks
    mixed = corpus_pipeline.run(spark, SF).toPandas()
    assert set(mixed.doc_id) == seen[3] and (mixed.taken <= 2 * mixed["size"]).all()
