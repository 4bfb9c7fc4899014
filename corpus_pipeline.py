"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, benchmark decontamination, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
documents (doc_id, text, lang, source, n_chars); the last adds n_tokens and token_ids and has the decoded text as text. Other columns
of docs, whatever their names, are left out; an empty table gives an empty one. Nulls in lang and source pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.sentencepiece_bpe import encode_decode, model_path
from tidemark.llm.simhash_dedup import near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Ids up to which a set of dropped documents is broadcast; beyond it the join is a shuffle.
BROADCAST_IDS = 1_000_000


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs whose doc_id isn't in ids; rows with a null doc_id stay."""
    gone = C.staged(ids.distinct(), "dropped")
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, "doc_id", "left_anti")


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and so do lines frequent in their host. Null, empty and short texts are rejected; each row is a document, repeated ones too."""
    out = quality_rules(docs.select(*COLUMNS)).where("kept")
    removed = F.col("n_common_words") > 0
    return out.withColumns({"n_chars": F.when(removed, F.length("clean_text").cast("long")).otherwise(F.col("n_chars")), "text": F.col("clean_text")}).select(*COLUMNS)


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Duplicate lines go, and with them documents all of whose lines with a word are copies of earlier ones. Null, empty and wordless texts stay,
    and so do rows with a null doc_id, whole; rows that repeat a doc_id are one document and both stay."""
    out = dedup_lines(docs.select(*COLUMNS)).where("n_removed = 0 or " + r"text rlike '[^\\x20\\x09-\\x0D]'")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def stage_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays. Null and wordless texts are near duplicates of each other;
    rows that repeat the smallest doc_id stay, and so do rows with a null doc_id."""
    return _without(docs, near_duplicates(docs).where("doc_id <> component_id").select("doc_id")).select(*COLUMNS)


def stage_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go: all rows of their doc_id. Null and empty texts hold none; rows with a null doc_id stay."""
    return _without(docs, contaminated(docs, C.table(spark, sf_dir, "benchmark")).where("doc_id is not null").select("doc_id")).select(*COLUMNS)


def stage_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and the text they decode to; a null text has no ids and an empty one."""
    out = encode_decode(docs.select(*COLUMNS), model_path())
    return out.select("doc_id", F.col("decoded").alias("text"), "lang", "source", F.length("decoded").cast("long").alias("n_chars"), "n_tokens", "token_ids")


STAGES = [("quality_rules", stage_quality), ("line_dedup", stage_lines), ("simhash_dedup", stage_near), ("decontaminate", stage_benchmark), ("sentencepiece", stage_encode)]

#: XXH64 fingerprints and BPE can't be stated in SQL; each stage calls an operator that tests hold against SQL or brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
