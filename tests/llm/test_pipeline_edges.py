"""The pipeline's stages on rows with nulls, repeated rows, clashing columns, and on no rows."""

from __future__ import annotations

import corpus_pipeline
from croplake.llm import common

SF = "/root/testdata/sf0.001"


def test_stages_of_odd_rows_and_none(spark):
    docs = common.table(spark, SF, "documents")
    text = " ".join(f"odd{i}" for i in range(300))
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, text, None, None, 3), (-1, None, None, "src0", 0), (-2, "", "en", None, 0), (-3, text, "en", "src0", 9), (-3, text, "en", "src0", 9), (-4, text + " end", "xx", "new", 1)],
        docs.schema,
    )
    for rows, least in ((docs.unionByName(odd), 100), (docs.limit(0), 0)):
        now = common.written(rows, "odd")
        for name, stage in corpus_pipeline.STAGES:
            got = common.written(stage(spark, now, SF), name)
            if name != "mixing":
                assert got.columns == docs.columns, name
                now = got
        kept = [r["doc_id"] for r in got.select("doc_id").collect()]
        assert len(kept) >= least and kept.count(-3) <= 2
    assert not kept
