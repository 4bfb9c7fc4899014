"""Queries of the subpackage, each over its whole table with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from tidemark.llm import decontaminate, language_id, line_dedup, lm_score, quality_rules, secret_scan, sentencepiece_bpe, simhash_dedup, substring_dedup, warc
from tidemark.llm.common import table

QUERIES = {
    "op1_substring_dedup": lambda spark, d: substring_dedup.op1_substring_dedup(table(spark, d, "documents")),
    "op2_language_id": lambda spark, d: language_id.op2_language_id(table(spark, d, "documents")),
    "op3_simhash_dedup": lambda spark, d: simhash_dedup.op3_simhash_dedup(table(spark, d, "documents")),
    "op4_secret_scan": lambda spark, d: secret_scan.op4_secret_scan(table(spark, d, "documents")),
    "op5_sentencepiece": lambda spark, d: sentencepiece_bpe.op5_sentencepiece(table(spark, d, "documents")),
    "op6_decontaminate": lambda spark, d: decontaminate.op6_decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op7_lm_score": lambda spark, d: lm_score.op7_lm_score(table(spark, d, "documents")),
    "op8_warc": lambda spark, d: warc.op8_warc(table(spark, d, "pages")),
    "op9_line_dedup": lambda spark, d: line_dedup.op9_line_dedup(table(spark, d, "documents")),
    "op10_quality_rules": lambda spark, d: quality_rules.op10_quality_rules(table(spark, d, "documents")),
}

ORACLES = {
    "op1_substring_dedup": substring_dedup.ORACLE,
    "op4_secret_scan": secret_scan.oracle(),
    "op6_decontaminate": decontaminate.ORACLE,
    "op8_warc": warc.ORACLE,
    "op9_line_dedup": line_dedup.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
}
