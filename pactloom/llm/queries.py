"""The operators of this package as queries over the test tables, beside SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pactloom.llm import (
    bloom_search,
    decontamination,
    hard_negatives,
    hilbert,
    host_reputation,
    language,
    minhash,
    mixing,
    notices,
    site_lines,
    suffixes,
    warc,
    winnowing,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        minhash.op1_dart_minhash,
        suffixes.op2_suffix_array,
        winnowing.op3_winnowing,
        host_reputation.op4_host_reputation,
        language.op5_kneser_ney,
        mixing.op6_soft_mixing,
        decontamination.op7_template_decontamination,
        notices.op8_short_notices,
        warc.op9_warc_dictionary,
        site_lines.op10_site_lines,
        bloom_search.op11_bloom_search,
        hard_negatives.op12_maximus_negatives,
        hilbert.op13_hilbert_shards,
    )
}

SQL: dict[str, str] = {
    "op4_host_reputation": host_reputation.OP4_SQL,
    "op9_warc_dictionary": warc.OP9_SQL,
    "op10_site_lines": site_lines.OP10_SQL,
    "op11_bloom_search": bloom_search.OP11_SQL,
    "op12_maximus_negatives": hard_negatives.OP12_SQL,
}
