"""Repeated runs of tokens over a corpus: seed by winnowed anchors, extend, keep what reaches the threshold.

A window is ``window`` consecutive tokens of one document. The smallest hash of its runs of ``anchor`` tokens
(the leftmost if equal) is its seed, so equal windows have equal seeds at equal places: no repeat of the
threshold's length is missed. Consecutive windows with one seed form a unit, the seed extended both ways as
far as it is the seed.

1. Seeds are counted; those that occur once are through. A bit table of fixed size (``FILTER_BITS`` at most, a
   sketch and not the seeds) tells the second reading which units can matter; a false hit costs a row and
   changes nothing.
2. Units that are equal as a whole are one class; its first occurrence is a grouped minimum. All windows of
   the others are repeats.
3. Only the first of each class can still have windows that occur earlier in another class with the same seed.
   Their windows are written out and grouped by hash, and the maximal covered ranges go back to the documents
   by one join.

Hashes of windows are 64 bits beside the 64 bits of their seed. Every step that meets a frequent key is a
grouped minimum with a map-side part or a join that Spark may split.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemline.llm.common import Rolling, Workspace, free_names, mixed, run_hashes, text_pieces, words

#: Bits of the largest sketch, 16 MB; a smaller one has 16 bits for each key.
FILTER_BITS = 1 << 27
LAST = (1 << 63) - 1

_SEEDS, _RUNS = Rolling(21), Rolling(22)
_PLACE = (1 << 30) - 1


@dataclass(frozen=True)
class Runs:
    """What a repeated run is: how texts become tokens, the threshold, the seed's length, whether a document can repeat itself, and the
    words that a window has at least."""

    tokens: Callable
    window: int
    anchor: int
    within: bool
    least_words: int = 0

    def __post_init__(self):
        if not 1 <= self.anchor <= self.window:
            raise ValueError("an anchor has between one token and the window's tokens")


@dataclass
class Units:
    """Units of a piece of texts: text number, first window and number of windows, hashes of seed and of all tokens."""

    text: np.ndarray
    start: np.ndarray
    count: np.ndarray
    seed: np.ndarray
    whole: np.ndarray
    prefix: np.ndarray
    first: np.ndarray


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width`` values."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def find_units(data: np.ndarray, offsets: np.ndarray, runs: Runs) -> Units | None:
    starts, ends, first = runs.tokens(data, offsets)
    if len(starts) < runs.window:
        return None
    if len(starts) > _PLACE:
        raise ValueError("a text has more than 2^30 tokens")
    tokens = run_hashes(data, starts, ends)
    n = len(tokens)
    seeds_prefix, prefix = _SEEDS.prefix(tokens), _RUNS.prefix(tokens)
    at = np.arange(n - runs.anchor + 1)
    seeds = _SEEDS.ranges(seeds_prefix, at, at + runs.anchor)
    keys = (seeds & ~np.uint64(_PLACE)) | at.astype(np.uint64)
    place = (sliding_min(keys, runs.window - runs.anchor + 1) & np.uint64(_PLACE)).astype(np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole_windows = text[: n - runs.window + 1] == text[runs.window - 1 :]
    if runs.least_words:
        begun = words(data, offsets)[0]
        n_words = np.searchsorted(begun, ends[runs.window - 1 :]) - np.searchsorted(begun, starts[: n - runs.window + 1])
        whole_windows &= n_words >= runs.least_words
    valid = np.flatnonzero(whole_windows)
    if not len(valid):
        return None
    new = np.ones(len(valid), bool)
    new[1:] = (np.diff(valid) != 1) | (np.diff(place[valid]) != 0) | (np.diff(text[valid]) != 0)
    lead = np.flatnonzero(new)
    count = np.diff(np.concatenate([lead, [len(valid)]]))
    low = valid[lead]
    whole = _RUNS.ranges(prefix, low, low + count + runs.window - 1) ^ mixed(count.astype(np.uint64))
    return Units(text[low], low - first[text[low]], count, seeds[place[low]], whole, prefix, first)


def window_hashes(units: Units, pick: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit, offset and hash of each window of the picked units."""
    unit = np.repeat(pick, units.count[pick])
    offset = np.arange(len(unit)) - np.repeat(np.cumsum(units.count[pick]) - units.count[pick], units.count[pick])
    at = units.first[units.text[unit]] + units.start[unit] + offset
    return unit, offset, _RUNS.ranges(units.prefix, at, at + window)


def bit_table(keys: DataFrame, n: int) -> np.ndarray:
    """A bit table of the long column ``key``: a fixed number of bits, whatever the number of keys."""
    bits = 1 << 10
    while bits < min(16 * n, FILTER_BITS):
        bits *= 2
    slot = F.col("key").bitwiseAND(F.lit(bits - 1))
    bit = F.expr("shiftleft(1L, int(key & 63))")
    words = keys.select(F.shiftright(slot, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("b"))
    got = words.toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[got.column("word").to_numpy()] = got.column("b").to_numpy().view(np.uint64)
    return table


def in_table(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & np.uint64(64 * len(table) - 1)
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)) == 1


def _unit_key(whole, rank, text_key, start):
    return whole ^ text_key ^ (rank << np.uint64(20)) ^ start


def _scan(docs: DataFrame, runs: Runs, schema: str, emit: Callable) -> DataFrame:
    def run(batches):
        for rows, data, offsets in text_pieces(batches, "text"):
            units = find_units(data, offsets, runs)
            if units is not None:
                rank, key = (rows.column(rows.schema.get_field_index(c)).to_numpy() for c in ("rank", "text_key"))
                made = emit(units, rank[units.text], key[units.text])
                if len(made[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names)

    names = [part.split()[0] for part in schema.split(", ")]
    return docs.select("rank", "text_key", "text").mapInArrow(run, schema)


def _long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _seed_counts(units: Units, rank, _):
    seed, back, n = np.unique(units.seed, return_inverse=True, return_counts=True)
    low, high = np.full(len(seed), LAST), np.full(len(seed), -LAST - 1)
    np.minimum.at(low, back, rank)
    np.maximum.at(high, back, rank)
    return _long(seed), low, high, n


def _repeat_test(runs: Runs, low: Column, rank: Column, text_key: Column, start: Column) -> Column:
    """Whether the place ``low`` comes before a window's own place in the sense of ``runs``."""
    return low < F.struct(rank, text_key, start) if runs.within else low["rank"] < rank


def repeated_ranges(docs: DataFrame, runs: Runs, work: Workspace) -> DataFrame:
    """(rank, text_key, ranges): token ranges [start, start+length) that occur earlier, for documents that have some.

    ``docs`` has ``rank`` (long, the order of documents), ``text_key`` and ``text``.
    """
    spark, place = docs.sparkSession, F.struct("rank", "text_key", "start")
    counts = _scan(docs, runs, "seed long, low long, high long, n long", _seed_counts)
    shared = counts.groupBy("seed").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    shared = shared.filter("n > 1" if runs.within else "low < high").select(F.col("seed").alias("key"))
    shared = work.write(shared, "seeds")
    seeds = spark.sparkContext.broadcast(bit_table(shared, shared.count()))

    def own_units(units, rank, key):
        pick = np.flatnonzero(in_table(seeds.value, units.seed))
        columns = units.seed, units.whole, rank, key, units.start, units.count
        return [_long(x[pick]) for x in columns]

    units = work.write(
        _scan(docs, runs, "seed long, whole long, rank long, text_key long, start long, n long", own_units), "units"
    )
    classes = work.write(
        units.groupBy("seed", "whole").agg(F.min(place).alias("low"), F.count("*").alias("members")), "classes"
    )
    several = classes.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1").select("seed")
    several = work.write(several, "several")
    firsts = work.write(classes.join(several, "seed", "left_semi").select("seed", "whole", "low.*"), "firsts")
    key = (
        F.col("whole").bitwiseXOR(F.col("text_key")).bitwiseXOR(F.shiftleft("rank", 20)).bitwiseXOR(F.col("start"))
    )
    wanted = spark.sparkContext.broadcast(bit_table(firsts.select(key.alias("key")), firsts.count()))

    def own_windows(units, rank, key):
        keys = _unit_key(units.whole, rank.view(np.uint64), key.view(np.uint64), units.start.astype(np.uint64))
        pick = np.flatnonzero(in_table(wanted.value, keys) & in_table(seeds.value, units.seed))
        unit, offset, hashes = window_hashes(units, pick, runs.window)
        columns = units.seed[unit], units.whole[unit], rank[unit], key[unit], units.start[unit], offset, hashes
        return [_long(x) for x in columns]

    schema = "seed long, whole long, rank long, text_key long, start long, offset long, hash long"
    windows = _scan(docs, runs, schema, own_windows).join(
        firsts, ["seed", "whole", "rank", "text_key", "start"], "left_semi"
    )
    windows = work.write(windows.withColumn("start", F.col("start") + F.col("offset")), "windows")
    # Written first, so that both sides of the join are exchanged and Spark can split a frequent window.
    lows = work.write(windows.groupBy("seed", "hash").agg(F.min(place).alias("low")), "lows")
    earlier = _repeat_test(runs, F.col("low"), F.col("rank"), F.col("text_key"), F.col("start"))
    masks = (
        windows.join(lows, ["seed", "hash"])
        .filter(earlier)
        .groupBy("seed", "whole")
        .agg(F.collect_set("offset").alias("offsets"))
    )
    marked = classes.join(masks, ["seed", "whole"], "left").filter("members > 1 OR offsets IS NOT NULL")
    marked = work.write(marked, "marked")
    later = _repeat_test(runs, F.col("low"), F.col("rank"), F.col("text_key"), F.col("start"))
    whole_unit = F.array(F.struct(F.col("start"), (F.col("n") + runs.window - 1).alias("length")))
    parts = F.transform(
        F.coalesce("offsets", F.array().cast("array<bigint>")),
        lambda o: F.struct((F.col("start") + o).alias("start"), F.lit(runs.window).cast("long").alias("length")),
    )
    ranges = (
        units.join(marked, ["seed", "whole"])
        .select("rank", "text_key", F.explode(F.when(later, whole_unit).otherwise(parts)).alias("range"))
        .groupBy("rank", "text_key")
        .agg(F.collect_set("range").alias("ranges"))
    )
    made = work.write(ranges, "ranges")
    for name in ("seeds", "units", "classes", "firsts", "windows", "lows", "marked", "several"):
        work.drop(name)
    return made


def without_repeats(
    docs: DataFrame,
    kinds: list[Runs],
    split: bytes | None,
    join: bytes,
    id_column: str,
    text: str,
    results: tuple[str, str, str] = ("n_tokens", "n_removed", "kept_text"),
) -> DataFrame:
    """``docs`` with ``results``: the number of tokens, of those removed, and those left, joined by ``join``.

    A token goes if a repeated run of any of the ``kinds`` covers it. Rows of equal id and text are one document. Null ids come
    after all others and are equal to each other. Columns with the names of results are replaced, all others stay.
    """
    names = [c for c in docs.columns if c not in results]
    rank, key, marks = free_names(docs, "_rank", "_text_key", "_ranges")
    keyed = docs.withColumns({rank: F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)), key: F.xxhash64(text)})
    narrow = keyed.filter(F.col(text).isNotNull()).select(
        F.col(rank).alias("rank"), F.col(key).alias("text_key"), F.col(text).alias("text")
    )
    parts = [repeated_ranges(narrow, runs, Workspace(docs.sparkSession, "runs")) for runs in kinds]
    found = parts[0]
    if len(parts) > 1:
        every = reduce(DataFrame.unionByName, parts).groupBy("rank", "text_key")
        found = every.agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    found = found.select(F.col("rank").alias(rank), F.col("text_key").alias(key), F.col("ranges").alias(marks))
    # A merge join at every size: with few ranges a broadcast would do, but then its cost jumps as the corpus grows.
    joined = keyed.join(found.hint("merge"), [rank, key], "left").select(*[F.col(f"`{c}`") for c in names], marks)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in names)

    def run(batches):
        for rows, data, offsets in text_pieces(batches, text):
            ranges = rows.column(rows.schema.get_field_index(marks))
            n_tokens, n_removed, kept = [], [], []
            raw, cuts = data.tobytes(), offsets.tolist()
            for i in range(rows.num_rows):
                tokens = raw[cuts[i] : cuts[i + 1]].split(split)
                gone = 0
                own = ranges[i].as_py()
                n_tokens.append(len(tokens))
                if own:
                    edge = np.zeros(len(tokens) + 1, np.int64)
                    np.add.at(edge, [r["start"] for r in own], 1)
                    np.add.at(edge, [r["start"] + r["length"] for r in own], -1)
                    stays = np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()
                    gone = len(tokens) - len(stays)
                    tokens = [tokens[k] for k in stays]
                n_removed.append(gone)
                kept.append(join.join(tokens).decode())
            columns = [rows.column(rows.schema.get_field_index(n)) for n in names]
            made = [pa.array(n_tokens, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *made], [*names, *results])

    added = "`{}` long, `{}` long, `{}` string".format(*results)
    return joined.mapInArrow(run, f"{fields}, {added}" if fields else added)
