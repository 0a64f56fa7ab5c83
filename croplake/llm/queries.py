"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import codebook, cover_sort, decontaminate, exact, filter_audit, html_text, jaccard, language, mixing, secret_scan, substring, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        toxicity.op1_toxicity, decontaminate.op2_benchmark_decontamination, warc.op3_warc_round_trip, secret_scan.op4_secret_scan, substring.op5_substring_dedup,
        jaccard.op6_ngram_jaccard_join, html_text.op7_html_text, language.op8_language_id, mixing.op9_mix_sources, exact.op10_exact_dedup,
        codebook.op11_vector_codes, filter_audit.op12_filter_audit, cover_sort.op13_suffix_dedup,
    )
}

#: Models, random draws and corpus-wide verdicts have no SQL; tests hold them against brute force.
ORACLES: dict[str, str] = {
    decontaminate.op2_benchmark_decontamination.__name__: decontaminate.ORACLE_SQL,
    warc.op3_warc_round_trip.__name__: warc.ORACLE_SQL,
    jaccard.op6_ngram_jaccard_join.__name__: jaccard.ORACLE_SQL,
    html_text.op7_html_text.__name__: html_text.ORACLE_SQL,
    exact.op10_exact_dedup.__name__: exact.ORACLE_SQL,
    codebook.op11_vector_codes.__name__: codebook.ORACLE_SQL,
    filter_audit.op12_filter_audit.__name__: filter_audit.ORACLE_SQL,
    cover_sort.op13_suffix_dedup.__name__: cover_sort.ORACLE_SQL,
}
