"""SimHash near-duplicates, compared bit-sliced.

Equal fingerprints are one class. Fingerprints within the radius agree in whole blocks of bits, so every
choice of blocks that must agree is a table of buckets that misses no pair; the number of blocks follows the
number of classes. Inside a bucket the fingerprints are stored as vertical bit planes. Row i is compared with
row i+d for 64 rows per machine word: carry-save counters add up the differing planes, and words in which
every distance is over the radius are dropped. Links leave a task as one edge per member to its smallest
partner, never as all pairs; components are found over all edges.

Null and empty texts, and texts of white space, have fingerprint zero and link like any other. Texts of fewer
words than a shingle have one shingle, the whole word sequence. Rows with a null ``doc_id`` take part; they
never name a component unless no row of it has an id (then ``component_id`` is null). Rows that repeat id and
text are one document and stay or go together.
"""

from __future__ import annotations

from array import array
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.llm.blocks import block_tasks, dealt, task_runs
from hemline.llm.common import LOWER_ASCII, Workspace, append_columns, read_table, texts_of
from hemline.llm.components import connected, local_roots

SHINGLE = 4
RADIUS = 4
SEED = 42
BUCKET_CAP = 4096
#: Fingerprints a bucket should hold on average.
BUCKET_MEAN = 32

_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, size: int) -> array:
    """XXH64 of the shingles of a text: words joined by one space, A-Z in lower case."""
    words = text.translate(LOWER_ASCII).split()
    out = array("Q")
    if words:
        joined, lengths, digest = b" ".join(words), [len(w) for w in words], xxhash.xxh64_intdigest
        starts = [0, *accumulate(n + 1 for n in lengths)]
        if len(words) <= size:
            out.append(digest(joined, SEED))
        else:
            ends = [s - 1 for s in starts[size:]]
            out.extend([digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=False)])
    return out


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive runs of hashes: a bit is 1 if set in over half of the run."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    starts = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
    # Eight bits are counted at a time in the byte lanes of a word, over at most 255 hashes.
    parts = -(-counts[some] // 255)
    owner = np.repeat(np.arange(len(some)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    cuts, first = starts[owner] + 255 * nth, np.flatnonzero(nth == 0)
    for j in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(j)) & _LANES, cuts).view(np.uint8).reshape(-1, 8)
        totals = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
        over = 2 * totals > counts[some][:, None]
        out[some] |= (over.astype(np.uint64) << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(j))).sum(
            axis=1, dtype=np.uint64
        )
    return out


def with_fingerprints(
    docs: DataFrame, size: int = SHINGLE, text: str = "text", keep_text: bool = True
) -> DataFrame:
    """``docs`` with ``fingerprint_bits`` (long, the 64 bits) of each whole text."""

    def make(data, offsets):
        own = [shingle_hashes(t, size) for t in texts_of(data, offsets)]
        flat = array("Q")
        for x in own:
            flat.extend(x)
        counts = np.array([len(x) for x in own])
        return {"fingerprint_bits": majority_bits(np.frombuffer(flat, np.uint64), counts).view(np.int64)}

    return append_columns(docs, text, {"fingerprint_bits": "long"}, make, keep_text)


def tables(n: int, radius: int) -> list[int]:
    """Masks of the bits that must agree; every pair within the radius agrees under at least one mask.

    Two blocks at least have to agree: fewer tables of larger buckets would do for small inputs, but then rows per
    fingerprint would jump as the corpus grows.
    """
    for keep in range(2, 64 - radius):
        blocks = radius + keep
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        least = sum(sorted(b - a for a, b in zip(cuts, cuts[1:], strict=False))[:keep])
        if n >> least <= BUCKET_MEAN or blocks >= 2 * radius:
            break
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(pick) for pick in combinations(masks, keep)]


def near_pairs(values: np.ndarray, task: np.ndarray, radius: int):
    """Rows (i, j) of the same task whose 64-bit values differ in at most ``radius`` bits, by distance of rows.

    Tasks are consecutive. Yields two index arrays per row distance that has pairs. The planes are built once and
    shifted; they are built anew when half of the rows belong to tasks that are through.
    """
    ends = np.searchsorted(task, task, "right")
    sizes = ends - np.searchsorted(task, task)
    counters, most = max(1, int(radius).bit_length()), int(sizes.max(initial=0))
    rows = planes = last = None
    for d in range(1, most):
        if rows is None or 2 * np.count_nonzero(sizes[rows] > d) <= len(rows):
            rows = np.flatnonzero(sizes > d)  # whole tasks, so neighbours stay neighbours
            planes, last = _planes(values[rows]), np.searchsorted(task[rows], task[rows], "right")
        beyond = np.arange(len(rows)) + d >= last
        over = np.full(planes.shape[1] - 2, ~np.uint64(0))
        over.view(np.uint8)[: -(-len(rows) // 8)] = np.packbits(beyond, bitorder="little")
        if len(rows) % 64:
            over[len(rows) // 64] |= ~np.uint64(0) << np.uint64(len(rows) % 64)
        live = np.flatnonzero(over != ~np.uint64(0))
        over = over[live]
        count = [np.zeros(len(live), np.uint64) for _ in range(counters)]
        at, low = live + d // 64, np.uint64(d % 64)
        for plane in range(64):
            own = planes[plane]
            other = own[np.minimum(at, len(own) - 2)]
            if low:
                other = other >> low | own[np.minimum(at + 1, len(own) - 1)] << (np.uint64(64) - low)
            carry = own[live] ^ other
            for k in range(counters):
                count[k], carry = count[k] ^ carry, count[k] & carry
            over |= carry
            if plane % 8 == 7:
                keep = (over | _greater(count, radius)) != ~np.uint64(0)
                if not keep.all():
                    live, over, at = live[keep], over[keep], at[keep]
                    count = [c[keep] for c in count]
                if not len(live):
                    break
        if len(live):
            near = ~(over | _greater(count, radius))
            word, bit = np.nonzero(np.unpackbits(near.view(np.uint8), bitorder="little").reshape(-1, 64))
            found = live[word] * 64 + bit
            if len(found):
                yield rows[found], rows[found + d]


def _greater(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is over the radius."""
    over, same = np.zeros_like(count[0]), ~np.zeros_like(count[0])
    for k in reversed(range(len(count))):
        if radius >> k & 1:
            same &= count[k]
        else:
            over |= same & count[k]
            same &= ~count[k]
    return over


def _planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of the values, 64 rows a word, with two words of zeros behind."""
    n = -(-len(values) // 64) * 64 + 128
    padded = np.zeros(n, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.packbits(bits.T, axis=1, bitorder="little").copy().view(np.uint64)


def linked_fingerprints(work: Workspace, prints: DataFrame, n: int, radius: int) -> DataFrame:
    """Edges (a, b) that connect the distinct values ``bits`` within the radius of each other."""
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in tables(n, radius)]
    keys = [F.struct(F.lit(i).alias("t"), F.col("bits").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]
    members = prints.select("bits", F.explode(F.array(*keys)).alias("k")).select("bits", "k.t", "k.key")

    def run(batches):
        for table, task in task_runs(batches, ["t", "key"]):
            bits = table.column("bits").to_numpy()
            a, b, label = [], [], np.arange(len(bits))
            for i, j in near_pairs(bits.view(np.uint64), task, radius):
                new = label[i] != label[j]
                a.append(i[new])
                b.append(j[new])
                if sum(map(len, a)) > 500_000:
                    label = local_roots(len(bits), np.concatenate(a), np.concatenate(b))
                    a, b = [np.arange(len(bits))], [label]
            if a:
                label = local_roots(len(bits), np.concatenate(a), np.concatenate(b))
            own = np.flatnonzero(label != np.arange(len(bits)))
            yield pa.RecordBatch.from_arrays([pa.array(bits[own]), pa.array(bits[label[own]])], ["a", "b"])

    tasks = block_tasks(work, members, ["t", "key"], "bits", BUCKET_CAP)
    return dealt(tasks, ["t", "key"]).mapInArrow(run, "a long, b long").distinct()


def near_copies(
    docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, text_key, fingerprint_bits, component_id, kept) per row of ``docs``.

    ``text_key`` tells rows of the same id apart; ``kept`` marks the document with the smallest id (then key) of each component.
    """
    work = Workspace(docs.sparkSession, "simhash")
    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text")
    )
    prints = work.write(with_fingerprints(narrow, size, keep_text=False), "prints")
    smallest = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    classes = work.write(
        prints.groupBy(F.col("fingerprint_bits").alias("bits")).agg(smallest.alias("low")), "classes"
    )
    roots = connected(work, linked_fingerprints(work, classes.select("bits"), classes.count(), radius), "a", "b")
    labelled = classes.join(roots, F.col("bits") == F.col("node"), "left").withColumn(
        "root", F.coalesce("root", "bits")
    )
    lows = labelled.groupBy("root").agg(F.min("low").alias("first"))
    named = labelled.join(lows, "root").select(F.col("bits").alias("fingerprint_bits"), "first")
    first = F.col("first")
    return prints.join(named, "fingerprint_bits").select(
        "doc_id",
        "text_key",
        "fingerprint_bits",
        first["doc_id"].alias("component_id"),
        (F.col("doc_id").eqNullSafe(first["doc_id"]) & (F.col("text_key") == first["text_key"])).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each component, all columns as they are."""
    kept = near_copies(docs, size, radius).filter("kept").select("doc_id", "text_key").distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(kept["doc_id"]) & (F.xxhash64(docs["text"]) == kept["text_key"])
    return docs.join(kept, same, "left_semi")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_copies(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint_bits")), 16, "0").alias("fingerprint"), "component_id"
    )
