"""Helpers shared by the operators: texts as flat bytes, hashes of byte runs, appended columns.

Arrow hands a task its texts as one byte buffer with offsets. The helpers work on that buffer, in pieces of at
most ``PIECE`` bytes (or one text), so the memory of a task follows its longest text and not its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hemline.session import fresh_path

PIECE = 2_000_000
WHITE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _odd(seed: int) -> int:
    return int(np.random.default_rng(seed).integers(1 << 62, 1 << 63)) | 1


class Rolling:
    """Hashes of ranges of an array modulo 2^64, from prefix sums of value times base power."""

    def __init__(self, seed: int):
        base = _odd(seed)
        self._steps = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        self._up, self._down = (
            np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, step)])) for step in self._steps
        )

    def prefix(self, values: np.ndarray) -> np.ndarray:
        if len(values) >= len(self._up):
            self._grow(2 * len(values))
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self._up[: len(values)], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((prefix[ends] - prefix[starts]) * self._down[starts])


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


_BYTES = Rolling(11)
_BYTE_VALUES = np.random.default_rng(12).integers(1, 1 << 63, 256).astype(np.uint64)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs ``[start, end)``; runs are in order and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        upto = max(at + 1, int(np.searchsorted(ends, low + PIECE, "right")))
        high = int(ends[upto - 1])
        prefix = _BYTES.prefix(_BYTE_VALUES[data[low:high]])
        out[at:upto] = _BYTES.ranges(prefix, starts[at:upto] - low, ends[at:upto] - low)
        at = upto
    return out


def class_runs(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes of a class that don't cross text borders.

    Returns starts, ends and, per text and one beyond, the number of its first run.
    """
    keep = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], keep])[:-1]
    after = np.concatenate([keep, [False]])[1:]
    starts = np.flatnonzero(keep & (~before | edge[:-1]))
    ends = np.flatnonzero(keep & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words: runs of bytes other than ASCII white space."""
    return class_runs(data, offsets, ~WHITE)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines between line feeds, empty ones included; an empty text has one empty line."""
    feeds = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1], feeds + 1]))
    ends = np.sort(np.concatenate([feeds, offsets[1:]]))
    counts = np.searchsorted(feeds, offsets[1:]) - np.searchsorted(feeds, offsets[:-1]) + 1
    return starts, ends, np.concatenate([[0], np.cumsum(counts)])


def flat_texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or one row."""
    at, n = 0, len(offsets) - 1
    while at < n:
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, upto
        at = upto


def text_pieces(batches, column: str, most: int = PIECE):
    """(rows, data, offsets) of each piece of each Arrow batch."""
    for batch in batches:
        if batch.num_rows:
            data, offsets = flat_texts(batch.column(batch.schema.get_field_index(column)))
            for low, high in pieces(offsets, most):
                own = offsets[low : high + 1]
                yield batch.slice(low, high - low), data[own[0] : own[-1]], own - own[0]


def texts_of(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def append_columns(
    docs: DataFrame,
    text: str,
    fields: dict[str, str],
    make: Callable[[np.ndarray, np.ndarray], dict[str, object]],
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with the columns of ``fields`` (name: type), made from the text by ``make(data, offsets)``.

    A column of ``docs`` that has a new column's name is replaced.
    """
    kept = [f for f in docs.schema.fields if f.name not in fields]
    if text in fields:
        raise ValueError(f"the text column {text} can't be replaced")
    added = T.StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in fields.items()))
    out = [f for f in kept if keep_text or f.name != text]
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in out], *added.fields])
    names, kinds = [f.name for f in out], {f.name: to_arrow_type(f.dataType) for f in added.fields}

    def run(batches):
        for rows, data, offsets in text_pieces(batches, text):
            made = make(data, offsets)
            columns = [rows.column(rows.schema.get_field_index(n)) for n in names]
            new = [made[n] if isinstance(made[n], pa.Array) else pa.array(made[n], k) for n, k in kinds.items()]
            yield pa.RecordBatch.from_arrays([*columns, *new], [*names, *kinds])

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """The names with as many underscores in front as keep them apart from the columns of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


class Workspace:
    """Tables written to the shared folder during one operator, read back as new scans."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, fresh_path(spark, name)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Delete a table that no later job reads, or all."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Index:
    """Position of 64-bit keys in an array of distinct keys, by an open-addressing table; -1 for others."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(3 * len(keys)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.ascontiguousarray(keys).view(np.int64)
        self.table = np.full(1 << self.bits, -1, np.int32)
        at, left = self._slots(self.keys), np.arange(len(keys))
        while len(left):
            free = self.table[at[left]] < 0
            take, first = np.unique(at[left[free]], return_index=True)
            rows = left[free][first]
            self.table[take] = rows
            waits = np.ones(len(keys), bool)
            waits[rows] = False
            left = left[waits[left]]
            at[left] = (at[left] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        spread = mixed(keys.view(np.uint64))
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys) or not len(keys):
            return np.full(len(keys), -1, np.int64)
        keys = np.ascontiguousarray(keys).view(np.int64)
        at = self._slots(keys)
        got = self.table[at].astype(np.int64)
        more = np.flatnonzero((got >= 0) & (self.keys[got] != keys))
        while len(more):
            at[more] = (at[more] + 1) & self.mask
            now = self.table[at[more]].astype(np.int64)
            got[more] = now
            more = more[(now >= 0) & (self.keys[now] != keys[more])]
        return got
