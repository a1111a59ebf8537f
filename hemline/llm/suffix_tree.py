"""Language-model scores from a probabilistic suffix tree over words.

Counting is done by Spark over all training texts. Contexts grow from one word upwards: runs of n+1 words are
counted only where both runs of n words in them are frequent (a run can't be more frequent than its parts), so
each length costs one reading of the texts and one grouped sum. A bit table of fixed size tells the reading
which runs are frequent; a false hit costs a row and changes nothing. A context stays a state of the tree if
its next words diverge from those of its longest retained suffix: count times Kullback-Leibler divergence of at
least ``DIVERGENCE`` nats. A state's words have discounted frequencies; the mass left goes to its other words in
proportion to the longest retained suffix, down to the smoothed counts of single words, so every state's
distribution sums to one over known words and one unknown. A text is scored word by word by the longest state
that ends there.

Frequent means ``LEAST_COUNT`` times, at every size, so the tree grows with the texts. Its levels are written
tables with a row for each frequent run; contexts, suffixes and values meet by joins. A score is a sum: the
log10 probability under single words, plus for each run that ends in the text a step (of its last word after
its retained context) and a pass (to what follows it as a retained context). Steps and passes of the
``HEAD_RUNS`` most frequent runs are broadcast, all others join by the run's hash. Counts of single words are
exact for all words: the ``HEAD`` most frequent are broadcast, all others join by their hash. Words and runs are
told apart by 64-bit hashes.

Null and empty texts have only the end token. Rows with a null id are learned from and not held out. Without
training texts every probability is one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.llm.common import LOWER_ASCII, Index, Workspace, read_table, run_hashes, text_pieces, words
from hemline.llm.seeds import bit_table, in_table

DEPTH = 3
LEAST_COUNT = 4
DIVERGENCE = 8.0
DISCOUNT = 0.5
HEAD = 1_000_000
HEAD_RUNS = 1_000_000
END = -0x5EED0E4D0E4D0E4D
#: Distinct keys a task holds before it passes its counts on.
HELD = 1_000_000
HELD_RUNS = 500_000

_LOWER = np.frombuffer(LOWER_ASCII, np.uint8)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text closed by the end token, and where each text starts."""
    lowered = _LOWER[data]
    starts, ends, first = words(lowered, offsets)
    hashes = run_hashes(lowered, starts, ends).view(np.int64)
    return np.insert(hashes, first[1:], END), first + np.arange(len(first))


def summed(batches, keys_of, names: tuple[str, ...] = ("key",), most: int = HELD):
    """Counts of int64 keys over the pieces of a task: batches of ``names`` and n.

    ``keys_of`` gives the keys, and further columns that are the same for equal keys; the last columns are named.
    """
    held, size = [], 0

    def joined():
        *columns, n = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(columns[0], kind="stable")
        key = columns[0][order]
        lead = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return *(x[order[lead]] for x in columns), np.add.reduceat(n[order], lead)

    for rows, data, offsets in text_pieces(batches, "text"):
        columns = keys_of(rows, data, offsets)
        key, first, n = np.unique(columns[0], return_index=True, return_counts=True)
        if len(key):
            held.append((key, *(x[first] for x in columns[1:]), n))
            size += len(key)
        if size > most:
            held = [joined()]
            size = len(held[0][0])
            if size > most // 2:
                yield from _counted(held.pop(), names)
                size = 0
    if held:
        yield from _counted(joined(), names)


def _counted(columns, names):
    for at in range(0, len(columns[0]), 500_000):
        made = [pa.array(x[at : at + 500_000]) for x in columns[-len(names) - 1 :]]
        yield pa.RecordBatch.from_arrays(made, [*names, "n"])


@dataclass
class Level:
    """The most frequent runs of one length that change a score: what their last word adds after its retained context, what
    they pass on as a context, and whether they are retained as one."""

    index: Index
    step: np.ndarray
    passes: np.ndarray
    retained: np.ndarray


@dataclass
class Tree:
    """Head words with their counts, the head of the levels from runs of one word upwards, and a bit table of the other
    runs."""

    words: Index
    counts: np.ndarray
    total: int
    distinct: int
    levels: list[Level]
    others: np.ndarray

    @property
    def log_total(self) -> float:
        return float(np.log10(self.total + 0.5 * (self.distinct + 1)))


_MIX = [np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63)]
_LONG = 0x27D4EB2F165667C5 + 8


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _hash_long(x: np.ndarray, seed) -> np.ndarray:
    x = (_turned(x * _MIX[1], 31) * _MIX[0]) ^ seed
    x = _turned(x, 27) * _MIX[0] + _MIX[3]
    x = (x ^ (x >> np.uint64(33))) * _MIX[1]
    x = (x ^ (x >> np.uint64(29))) * _MIX[2]
    return x ^ (x >> np.uint64(32))


def longer(run: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of runs with one more word; as xxhash64(run, word) in Spark."""
    seed = _hash_long(run.view(np.uint64), np.uint64(42 + _LONG)) + np.uint64(_LONG)
    return _hash_long(word.view(np.uint64), seed).view(np.int64)


def run_keys(hashes: np.ndarray, starts: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length, the key of the run that ends at each token, and whether it lies in one text."""
    begins = np.zeros(len(hashes) + 1, bool)
    begins[starts] = True
    out = [(hashes, np.ones(len(hashes), bool))]
    for _ in range(depth - 1):
        key, fits = out[-1]
        before, inside = np.roll(key, 1), np.roll(fits, 1) & ~begins[:-1]
        out.append((longer(before, hashes), inside))
    return out


def word_counts(docs: DataFrame, work: Workspace) -> DataFrame:
    """(key, n) of every token of ``text``, written."""

    def run(batches):
        yield from summed(batches, lambda _, data, offsets: tokens(data, offsets)[:1])

    counted = docs.select("text").mapInArrow(run, "key long, n long")
    return work.write(counted.groupBy("key").agg(F.sum("n").alias("n")), "words")


def head_threshold(counts: DataFrame, most: int) -> int:
    """Smallest count such that at most ``most`` words have it or more; from a histogram of at most some hundred bins."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    bins = counts.groupBy(step.alias("bin")).agg(F.count("*").alias("words"), F.min("n").alias("low")).orderBy("bin")
    threshold, room = (1 << 62), most
    for row in reversed(bins.collect()):
        room -= row["words"]
        if room < 0:
            break
        threshold = row["low"]
    return threshold


def run_counts(docs: DataFrame, level: DataFrame, length: int, least: int, work: Workspace) -> DataFrame:
    """(prefix, word, n) of the runs of ``length`` words that occur ``least`` times, written; ``level`` has the runs of one
    word less."""
    frequent = docs.sparkSession.sparkContext.broadcast(bit_table(level.select("key"), level.count()))

    def run(batches):
        def keys_of(_, data, offsets):
            hashes, starts = tokens(data, offsets)
            (part, _), (key, fits) = run_keys(hashes, starts, length)[-2:]
            known = in_table(frequent.value, part.view(np.uint64))
            at = np.flatnonzero(fits & known & np.roll(known, 1))
            return key[at], part[at - 1], hashes[at]

        yield from summed(batches, keys_of, ("prefix", "word"), HELD_RUNS)

    counted = docs.select("text").mapInArrow(run, "prefix long, word long, n long")
    # A task has summed its runs, and most of them are rare: another sum before the exchange would only hold them again.
    counted = counted.repartition("prefix", "word").groupBy("prefix", "word").agg(F.sum("n").alias("n"))
    made = work.write(counted.filter(F.col("n") >= least), f"counted{length}")
    frequent.unpersist()
    return made


def grow(
    docs: DataFrame,
    work: Workspace,
    depth: int = DEPTH,
    least_count: int = LEAST_COUNT,
    least_share: float = 0.0,
    divergence: float = DIVERGENCE,
    head: int = HEAD,
    head_runs: int = HEAD_RUNS,
) -> tuple[Tree, DataFrame]:
    """The tree learned from ``text`` of all rows of ``docs``, and (length, key, n, weight) of what is outside its heads:
    words under length 0, runs under their length."""
    counts = word_counts(docs, work)
    row = counts.agg(F.sum("n").alias("total"), F.count("*").alias("distinct")).first()
    total, distinct = int(row["total"] or 0), int(row["distinct"])
    least = max(least_count, int(np.ceil(least_share * total)))
    threshold = head_threshold(counts, head)
    top = counts.filter(F.col("n") >= threshold).toArrow()
    tree = Tree(Index(top["key"].to_numpy()), top["n"].to_numpy(), total, distinct, [], np.empty(0, np.uint64))
    weights = run_weights(docs, counts, tree.log_total, least, depth, divergence, work)
    limit = head_threshold(weights, head_runs)
    rest = weights.filter(F.col("n") < limit)
    tree.others = bit_table(rest.select("key"), rest.count())
    frequent = weights.filter(F.col("n") >= limit).toArrow()
    lengths = frequent["length"].to_numpy()
    for length in range(1, weights.agg(F.max("length")).first()[0] + 1 if weights.head(1) else 1):
        own = frequent.filter(pa.array(lengths == length))
        step, passes = (own[c].to_numpy() for c in ("step", "passes"))
        retained = ~np.isnan(passes)
        tree.levels.append(Level(Index(own["key"].to_numpy()), step, np.where(retained, passes, 0.0), retained))
    tail = counts.filter(F.col("n") < threshold).select(F.lit(0).alias("length"), "key", "n", F.lit(0.0).alias("weight"))
    weight = F.col("step") + F.nanvl("passes", F.lit(0.0))
    return tree, tail.unionAll(rest.select("length", "key", "n", weight.alias("weight")))


def run_weights(
    docs: DataFrame, counts: DataFrame, log_total: float, least: int, depth: int, divergence: float, work: Workspace
) -> DataFrame:
    """(length, key, n, step, passes) of the frequent runs that change a score, written; passes is NaN if not retained.

    Divergence tests and smoothed distributions, from short contexts to long ones. ``value`` of a run is the log10
    probability of its last word after the longest retained context inside the run.
    """
    value = F.log10(F.col("n") + 0.5) - F.lit(log_total)
    level = counts.filter(F.col("n") >= least).select("key", F.lit(0).cast("long").alias("suffix"), "n", value.alias("value"))
    level = work.write(level, "level1")
    none = F.lit(float("nan"))
    parts = [level.limit(0).select(F.lit(1).alias("length"), "key", "n", F.lit(0.0).alias("step"), none.alias("passes"))]
    for length in range(2, depth + 2):
        # Written before their joins, so that both sides are exchanged and Spark can split a frequent context.
        counted = run_counts(docs, level, length, least, work)
        if counted.isEmpty():
            break
        suffix = F.col("word") if length == 2 else F.xxhash64("inner", "word")
        prefixes = level.select(F.col("key").alias("prefix"), F.col("suffix").alias("inner"), F.col("n").alias("n_prefix"))
        pairs = counted.join(prefixes, "prefix").select(
            "prefix", F.xxhash64("prefix", "word").alias("key"), suffix.alias("suffix"), "n", "n_prefix"
        )
        pairs = work.write(
            pairs.join(level.select(F.col("key").alias("suffix"), F.col("value").alias("below")), "suffix"), f"pairs{length}"
        )
        share = (F.col("n") - DISCOUNT) / F.col("n_prefix")
        gain = F.col("n") * (F.log(F.col("n") / F.col("n_prefix")) - F.col("below") * float(np.log(10)))
        left, other = 1 - F.sum(share), 1 - F.sum(F.pow(F.lit(10.0), F.col("below")))
        passes = F.log10(F.greatest(left, F.lit(1e-12)) / F.greatest(other, F.lit(1e-12)))
        contexts = pairs.groupBy("prefix").agg(F.sum(gain).alias("gain"), F.max("n_prefix").alias("n"), passes.alias("passes"))
        contexts = work.write(contexts.filter(F.col("gain") >= divergence).drop("gain"), f"contexts{length}")
        explicit, stays = F.log10(share), F.col("passes").isNotNull()
        level = work.write(
            pairs.join(contexts.select("prefix", "passes"), "prefix", "left").select(
                "key",
                "suffix",
                "n",
                F.when(stays, explicit).otherwise(F.col("below")).alias("value"),
                F.when(stays, explicit - F.col("below") - F.col("passes")).alias("step"),
            ),
            f"level{length}",
        )
        parts.append(contexts.select(F.lit(length - 1), "prefix", "n", F.lit(0.0), "passes"))
        parts.append(level.filter("step IS NOT NULL").select(F.lit(length), "key", "n", "step", none))
        for name in ("counted", "pairs"):
            work.drop(f"{name}{length}")
    made = parts[0]
    for part in parts[1:]:
        made = made.unionAll(part)
    # A run has at most one step and one pass; NaN is the largest number.
    both = made.groupBy("length", "key", "n").agg(F.sum("step").alias("step"), F.min("passes").alias("passes"))
    weights = work.write(both, "weights")
    for length in range(1, depth + 2):
        work.drop(f"level{length}")
        work.drop(f"contexts{length}")
    return weights


def _parts(tree: Tree, hashes: np.ndarray, starts: np.ndarray):
    """What ``score_tokens`` gives, and the last tokens and keys of runs that may have a weight outside the head."""
    place, none = tree.words.find(hashes), (np.empty(0, np.int64), np.empty(0, np.int64))
    if not len(tree.counts):
        return np.zeros(len(place)), np.zeros(len(place)), place, none
    base = np.where(place >= 0, np.log10(tree.counts[np.maximum(place, 0)] + 0.5) - tree.log_total, 0.0)
    begins, value, open_at, open_keys = np.zeros(len(hashes) + 1, bool), base.copy(), [none[0]], [none[1]]
    begins[starts] = True
    begins[-1] = True
    runs = run_keys(hashes, starts, len(tree.levels)) if tree.levels else []
    for level, (key, fits) in zip(tree.levels, runs, strict=True):
        at = np.where(fits, level.index.find(key), -1)
        hit = np.flatnonzero(at >= 0)
        value[hit] += level.step[at[hit]]
        hit = hit[~begins[hit + 1]]
        value[hit + 1] += level.passes[at[hit]]
        miss = np.flatnonzero(fits & (at < 0))
        miss = miss[in_table(tree.others, key[miss].view(np.uint64))]
        open_at.append(miss)
        open_keys.append(key[miss])
    return base, value, place, (np.concatenate(open_at), np.concatenate(open_keys))


def score_tokens(tree: Tree, hashes: np.ndarray, starts: np.ndarray):
    """log10 probability of each token under single-word counts and under the tree, without the single-word part
    of words outside the head and the part of runs outside it; and each token's place in the head."""
    return _parts(tree, hashes, starts)[:3]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def score_texts(docs: DataFrame, training: DataFrame, **settings) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    ``training`` has the texts to learn from in ``text``; ``settings`` are those of ``grow``.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "suffix-tree")
    tree, tail = grow(training, work, **settings)
    shared = spark.sparkContext.broadcast(tree)

    def run(batches):
        now = shared.value
        for rows, data, offsets in text_pieces(batches, "text"):
            hashes, starts = tokens(data, offsets)
            base, value, place, (at, keys) = _parts(now, hashes, starts)
            order = np.argsort(at, kind="stable")
            cut, n = starts[:-1], np.diff(starts)
            outside = place < 0
            ends = np.cumsum(np.add.reduceat(outside, cut)) if len(cut) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(rows.schema.get_field_index("doc_id")),
                    pa.array(n),
                    pa.array(n - np.add.reduceat(outside, cut)),
                    pa.array(np.add.reduceat(base, cut)),
                    pa.array(np.add.reduceat(value, cut)),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(hashes[outside])
                    ),
                    pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(at[order], starts).astype(np.int32)), pa.array(keys[order])
                    ),
                ],
                ["doc_id", "n_tokens", "n_head", "base", "value", "others", "runs"],
            )

    made = "doc_id long, n_tokens long, n_head long, base double, value double, others array<long>, runs array<long>"
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, made)
    scored = work.write(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    shared.unpersist()
    others = (
        scored.select("row", F.explode("others").alias("key"))
        .groupBy("row", "key")
        .agg(F.count("*").alias("times"))
        .join(tail.filter("length = 0").select("key", "n"), "key", "left")
    )
    count = F.coalesce("n", F.lit(0))
    extra = others.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * (F.log10(count + 0.5) - tree.log_total)).alias("more"),
    )
    # Runs outside the head are not frequent, so their rows are joined as they are.
    runs = scored.select("row", F.explode("runs").alias("key")).join(tail.filter("length > 0").select("key", "weight"), "key")
    steps = runs.groupBy("row").agg(F.sum("weight").alias("steps"))
    more = F.coalesce("more", F.lit(0.0))
    return scored.join(extra, "row", "left").join(steps, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_head") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tree.total).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("value") + more + F.coalesce("steps", F.lit(0.0))).alias("score"),
    )


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_texts(docs, docs.filter(~held_out(F.col("doc_id"))))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )
