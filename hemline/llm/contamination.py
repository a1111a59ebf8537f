"""Benchmark decontamination with DataFrame functions only.

The word windows of the benchmark become a hash set that goes to the executors inside the plan, after a check
of its size; documents are read once, and each window whose hash is in the set is noted with its words. Notes
are verified by an equality join with the benchmark's windows as text. Beyond ``MOST_GRAMS`` windows the set
is a table and the windows of the documents meet it in a join that Spark may split.

Words are runs of digits, letters (A-Z in lower case) and characters beyond ASCII. An item of fewer words than
a window is one window; an item without words is none. Null texts have no words. Repeated items of equal words
all count. Items with a null id count under no id. Rows that repeat id and text are one document; an empty
benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.llm.common import Workspace, free_names, read_table

WINDOW = 13
SHARE = 20
MOST_GRAMS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters between words, as a regular expression; the second form is for text whose letters are not lowered.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def word_list(text: Column) -> Column:
    """Words of a text; only A-Z change case."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, f"{BETWEEN}+"), "")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(gram, length, hash, head, tail, items): each distinct window with the ids of its items as strings."""
    listed = benchmark.select(F.col("item_id").cast("string").alias("item_id"), word_list(F.col("text")).alias("words"))
    sized = listed.withColumn("length", F.least(F.size("words"), F.lit(window))).filter("length > 0")
    hashes = sized.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    at = F.explode(F.expr("sequence(1, size(words) - length + 1)")).alias("at")
    return (
        hashes.select("item_id", "words", "hashes", "length", at)
        .select(
            "item_id",
            "length",
            F.array_join(F.slice("words", F.col("at"), F.col("length")), " ").alias("gram"),
            F.xxhash64(F.slice("hashes", F.col("at"), F.col("length"))).alias("hash"),
            F.element_at("hashes", F.col("at")).alias("head"),
            F.element_at("hashes", F.col("at") + F.col("length") - 1).alias("tail"),
        )
        .groupBy("gram", "length", "hash", "head", "tail")
        .agg(F.collect_set("item_id").alias("items"))
    )


def _listed(values) -> str:
    return ", ".join(f"{v}L" if v != -(1 << 63) else "(-9223372036854775807L - 1L)" for v in sorted(set(values)))


def _in_set(windows: DataFrame) -> str | None:
    """SQL for the places (start, length) of a document's windows whose hash is in the benchmark's set."""
    rows = windows.select("length", "hash", "head", "tail").toArrow().to_pydict()
    parts = []
    for length in sorted(set(rows["length"])):
        own = [i for i, n in enumerate(rows["length"]) if n == length]
        sets = {k: _listed(rows[k][i] for i in own) for k in ("hash", "head", "tail")}
        parts.append(
            f"transform(filter(IF(n_words < {length}, cast(array() AS array<int>), sequence(1, n_words - {length - 1})),"
            f" i -> element_at(hashes, i) IN ({sets['head']})"
            f" AND element_at(hashes, i + {length - 1}) IN ({sets['tail']})"
            f" AND xxhash64(slice(hashes, i, {length})) IN ({sets['hash']})),"
            f" i -> named_struct('start', i, 'length', {length},"
            f" 'gram', array_join(slice(words, i, {length}), ' ')))"
        )
    return f"concat({', '.join(parts)})" if parts else None


def _noted(scanned: DataFrame, windows: DataFrame, most_grams: int) -> DataFrame:
    """(doc_id, text_key, n_words, notes) with the notes (start, length, gram) of each document."""
    note = "array<struct<start:int,length:int,gram:string>>"
    n = windows.count()
    if n <= most_grams:
        found = _in_set(windows)
        return scanned.selectExpr("doc_id", "text_key", "n_words", f"cast({found or 'array()'} AS {note}) AS notes")
    lengths = [r["length"] for r in windows.select("length").distinct().collect()]
    spots = F.explode(
        F.flatten(
            F.array(
                *[
                    F.expr(
                        f"IF(n_words >= {k}, transform(sequence(1, n_words - {k - 1}), i -> named_struct('start', i,"
                        f" 'length', {k}, 'hash', xxhash64(slice(hashes, i, {k})))), cast(array() AS"
                        " array<struct<start:int,length:int,hash:bigint>>))"
                    )
                    for k in sorted(lengths)
                ]
            )
        )
    )
    places = (
        scanned.select("doc_id", "text_key", spots.alias("s"))
        .select("doc_id", "text_key", "s.*")
        .join(windows.select("hash", "length").distinct(), ["hash", "length"], "left_semi")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("start", "length")).alias("places"))
    )
    places = places.withColumnsRenamed({"doc_id": "_doc_id", "text_key": "_text_key"})
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key"))
    joined = scanned.join(places, same, "left").select("doc_id", "text_key", "n_words", "words", "places")
    return joined.selectExpr(
        "doc_id",
        "text_key",
        "n_words",
        "cast(transform(coalesce(places, cast(array() AS array<struct<start:int,length:int>>)), p -> named_struct("
        f"'start', p.start, 'length', p.length, 'gram', array_join(slice(words, p.start, p.length), ' '))) AS {note}) AS notes",
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    share: int = SHARE,
    most_grams: int = MOST_GRAMS,
) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, items, ranges, contaminated), one row per row of ``docs``.

    ``items`` are the ids whose windows occur; ``ranges`` the hit runs of words (first, last, from 1). A document is
    contaminated if at least one in ``share`` of its words is hit.
    """
    work = Workspace(docs.sparkSession, "contamination")
    windows = work.write(benchmark_windows(benchmark, window), "windows")
    scanned = (
        docs.select("doc_id", F.xxhash64("text").alias("text_key"), word_list(F.col("text")).alias("words"))
        .withColumns({"n_words": F.size("words"), "hashes": F.transform("words", lambda w: F.xxhash64(w))})
    )
    noted = work.write(_noted(scanned, windows, most_grams), "noted")
    notes = noted.filter(F.size("notes") > 0).select("doc_id", "text_key", F.explode("notes").alias("n"))
    verified = (
        notes.select("doc_id", "text_key", "n.*")
        .join(windows.select("gram", "items"), "gram")
        .groupBy("doc_id", "text_key")
        .agg(
            F.collect_set(F.struct("start", "length")).alias("places"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
        .withColumn(
            "hit",
            F.expr("array_sort(array_distinct(flatten(transform(places, p -> sequence(p.start, p.start + p.length - 1)))))"),
        )
    )
    found = work.write(
        verified.select(
            F.col("doc_id").alias("_doc_id"),
            F.col("text_key").alias("_text_key"),
            F.size("hit").cast("long").alias("n_hit"),
            "items",
            F.expr(
                "transform(arrays_zip(filter(hit, (p, k) -> k = 0 OR element_at(hit, k) <> p - 1),"
                " filter(hit, (p, k) -> k = size(hit) - 1 OR element_at(hit, k + 2) <> p + 1)),"
                " r -> named_struct('first', r.`0`, 'last', r.`1`))"
            ).alias("ranges"),
        ),
        "found",
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key"))
    n_hit, n_words = F.coalesce("n_hit", F.lit(0).cast("long")), F.col("n_words").cast("long")
    return (
        noted.select("doc_id", "text_key", "n_words")
        .join(found, same, "left")
        .select(
            "doc_id",
            "text_key",
            n_words.alias("n_words"),
            n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            "ranges",
            ((n_hit > 0) & (n_hit * share >= n_words)).alias("contaminated"),
        )
    )


def _joined(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    found = found.withColumnsRenamed({"doc_id": "_doc_id", "text_key": "_text_key"})
    same = docs["doc_id"].eqNullSafe(found["_doc_id"]) & (F.xxhash64(docs["text"]) == found["_text_key"])
    return docs.join(found, same, how)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """``docs`` without the contaminated ones, columns as they are; a null text is not contaminated."""
    found = find_contamination(docs, benchmark, window, share).filter("contaminated")
    return _joined(docs, found.select("doc_id", "text_key").distinct(), "left_anti")


def cut_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` whose hit runs of words are replaced by one space; the rest of each text stays as it is."""
    marks, own = free_names(docs, "_ranges", "_words")
    found = (
        find_contamination(docs, benchmark, window)
        .filter("n_hit > 0")
        .groupBy("doc_id", "text_key")
        .agg(F.first("ranges").alias(marks))
    )
    runs = F.transform(
        marks,
        lambda r: F.array_join(F.slice(own, r["first"], r["last"] - r["first"] + 1), f"{BETWEEN_ANY_CASE}+"),
    )
    inside = "[^" + BETWEEN_ANY_CASE[1:]
    pattern = F.concat(F.lit(f"(?i)(?<!{inside})(?:"), F.array_join(runs, "|"), F.lit(f")(?!{inside})"))
    cut = F.when(F.col(marks).isNull(), F.col("text")).otherwise(F.regexp_replace("text", pattern, F.lit(" ")))
    joined = _joined(docs, found, "left").withColumn(own, word_list(F.col("text")))
    return joined.select(*[cut.alias(c) if c == "text" else docs[f"`{c}`"] for c in docs.columns])


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )
