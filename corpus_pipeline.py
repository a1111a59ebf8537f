"""The corpus pipeline: toxic documents go, repeated lines go, one of each group of near copies stays, contaminated documents
go, and what is left becomes piece ids.

Each stage works on all documents that its predecessor kept. Its result is written to the shared folder and read again, so a
lost executor costs one stage at most and no stage computes an earlier one anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.llm.common import Workspace, free_names, read_table
from hemline.llm.contamination import drop_contaminated
from hemline.llm.line_dedup import drop_repeated_lines
from hemline.llm.pieces import default_model, encode_digests
from hemline.llm.simhash import drop_near_copies
from hemline.llm.toxicity import THRESHOLD, score_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold."""
    score = free_names(docs, "tox_score")[0]
    scored = score_documents(docs, docs, read_table(spark, sf_dir, "labels"), name=score)
    return scored.filter(F.col(score) < THRESHOLD).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later repeats of runs of lines; ``n_chars`` follows the text."""
    n_lines, n_removed, kept = free_names(docs, "n_lines", "n_removed", "kept_text")
    made = drop_repeated_lines(docs, results=(n_lines, n_removed, kept)).withColumn("text", F.col(kept))
    changed = F.when(F.col(n_removed) > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return made.withColumn("n_chars", changed).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document left, as digests, and the round trip."""
    encoded = encode_digests(docs.select("doc_id", "text"), default_model(), keep_text=False)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("sentencepiece", encode),
]
#: Neither the learned score nor the piece ids can be said in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.write(stage(spark, docs, sf_dir), name)
    return docs
