"""Registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, bpe, fingerprints, katz, merkle, mixing, pii, quality, simhash, suffix_dedup, token_counts, urls, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": bpe.query,
    "op2_fingerprints": fingerprints.query,
    "op3_warc": warc.query,
    "op4_suffix_dedup": suffix_dedup.query,
    "op5_simhash": simhash.query,
    "op6_quality": quality.query,
    "op7_katz": katz.query,
    "op8_mixing": mixing.query,
    "op9_pii": pii.query,
    "op10_token_counts": token_counts.query,
    "op11_merkle": merkle.query,
    "op12_urls": urls.query,
    "op13_alignment": alignment.query,
}

ORACLES: dict[str, str] = {"op6_quality": quality.ORACLE, "op8_mixing": mixing.ORACLE, "op12_urls": urls.ORACLE}
