"""Substring dedup: repeats of at least ``window`` words are removed from all but the first document that has
them.

Words are runs of characters other than ASCII white space, unchanged. A word goes if a window that covers it
also starts in a document with a smaller id; windows are judged on the input. Null texts have no words, and
documents with fewer words than a window lose none. Repeats inside one document stay. Rows with a null id come
last. Rows of equal id are no reason to remove from one another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.llm.common import read_table, words
from hemline.llm.seeds import Runs, without_repeats

WINDOW = 50
ANCHOR = 10


def drop_repeated_words(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with ``n_tokens`` (words), ``n_removed`` and ``kept_text``."""
    runs = Runs(words, window, anchor, within=False)
    return without_repeats(docs, [runs], None, b" ", id_column, text)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = drop_repeated_words(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id",
        F.col("n_tokens").alias("n_words"),
        "n_removed",
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )
