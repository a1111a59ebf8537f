"""Line dedup: later repeats of runs of lines are deleted.

A run is ``min_lines`` or more consecutive lines, or one line of ``min_words`` words or more. A line goes if a run that covers it
also starts at an earlier place: in a document with a smaller id, or further up in its own. Runs are judged on the input. Lines
are compared whole and unchanged; words are what is between white space of ASCII; an empty text has one empty line. A null text has no lines and
stays null. Documents that lose all lines stay with an empty text. Rows with a null id come last; rows of equal id and
text are one document; rows of equal id and different texts come in the order of a hash of the text. So blank and very short lines
stay unless their neighbours are repeated with them. Columns with the names of results are replaced, all others stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.llm.common import lines, read_table
from hemline.llm.seeds import Runs, without_repeats

MIN_LINES = 2
MIN_WORDS = 5
ANCHOR = 1


def drop_repeated_lines(
    docs: DataFrame,
    min_lines: int = MIN_LINES,
    id_column: str = "doc_id",
    text: str = "text",
    min_words: int | None = MIN_WORDS,
    results: tuple[str, str, str] = ("n_lines", "n_removed", "kept_text"),
) -> DataFrame:
    """``docs`` with ``results``: the number of lines, of those removed, and the text left. Without ``min_words`` no single line is a
    run."""
    kinds = [Runs(lines, min_lines, min(ANCHOR, min_lines), within=True)]
    if min_words is not None and min_lines > 1:
        kinds.append(Runs(lines, 1, 1, within=True, least_words=min_words))
    made = without_repeats(docs, kinds, b"\n", b"\n", id_column, text, results)
    blank, (n_lines, _, kept) = F.col(text).isNull(), results
    return made.withColumns({kept: F.when(~blank, F.col(kept)), n_lines: F.when(blank, 0).otherwise(F.col(n_lines))})


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = drop_repeated_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
