"""Near-duplicate vectors: random hyperplanes, exact cosine, components.

Equal vectors are one class. Each class is hashed in several tables by the signs of its products with random
hyperplanes. The bits per table follow the number of classes, so a bucket stays small on average, and the
number of tables follows from ``recall``: the chance that a pair at the threshold shares a bucket. Members of
a bucket are compared by their exact cosine in double precision, in tasks of bounded size; a pair counts in
the first table that it shares. Only counts and one edge per member leave a task.

Vectors that are null, empty, zero or hold a null or non-finite component link with nothing and are their own
component. Rows with a null id take part in links; they never name a component that has an id. Vectors of
different lengths never link. Repeated rows count as vectors that are linked with each other.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.llm.blocks import block_tasks, dealt, task_runs
from hemline.llm.common import Workspace, read_table
from hemline.llm.components import connected, local_roots

THRESHOLD = 0.9
RECALL = 0.99
BUCKET_MEAN = 32
BLOCK = 1024
SEED = 17


def plan_tables(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits per table and number of tables for ``n`` classes."""
    bits = min(62, max(4, math.ceil(math.log2(max(n, 1) / BUCKET_MEAN))) if n > BUCKET_MEAN else 4)
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def sane(vector: Column) -> Column:
    """Whether a vector can link: finite components, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _directions(length: int, n: int) -> np.ndarray:
    return np.random.default_rng([SEED, length]).standard_normal((length, n))


def _matrix(column: pa.ChunkedArray, length: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, length)


def _hashed(classes: DataFrame, bits: int, n_tables: int) -> DataFrame:
    """Classes with their ``keys``, one per table, and the signs behind them, by which a later table tells a pair it has had."""

    def run(batches):
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("size")).to_numpy()
            for length in np.unique(lengths).tolist():
                own = pa.Table.from_batches([batch]).filter(pa.array(lengths == length))
                sides = _matrix(own.column("vector"), length) @ _directions(length, bits * n_tables) > 0
                keys = sides.reshape(-1, n_tables, bits) @ (np.int64(1) << np.arange(bits, dtype=np.int64))
                signs = [row.tobytes() for row in np.packbits(sides, axis=1)]
                made = own.append_column("signs", pa.array(signs, pa.binary()))
                yield from made.append_column("keys", pa.array(list(keys), pa.list_(pa.int64()))).to_batches()

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.select("node", "copies", "size", "vector").mapInArrow(
        run, f"node long, copies long, size int, vector {kind}, signs binary, keys array<long>"
    )


def _links(tasks: DataFrame, threshold: float, bits: int, n_tables: int) -> DataFrame:
    """Per task and member: rows linked by pairs that no earlier table has had, and an edge to the smallest partner."""

    def run(batches):
        for table, task in task_runs(batches, ["size", "t", "key"], 5_000):
            node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
            t, side = table.column("t").to_numpy(), table.column("side").to_numpy()
            sizes = table.column("size").to_numpy()
            blocks, blocks_b = (table.column(c).to_numpy() for c in ("task_a", "task_b"))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(task)) + 1, [len(task)]]).tolist()
            for low, high in zip(cuts, cuts[1:], strict=False):
                own = table.slice(low, high - low)
                x = _matrix(own.column("vector"), int(sizes[low]))
                packed = np.frombuffer(b"".join(own.column("signs").to_pylist()), np.uint8).reshape(high - low, -1)
                sides = np.unpackbits(packed, axis=1, count=bits * n_tables).reshape(high - low, n_tables, bits)
                keys = sides[:, : int(t[low])] @ (np.int64(1) << np.arange(bits, dtype=np.int64))
                s, linked, a, b = side[low:high], np.zeros(high - low, np.int64), [], []
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                two_blocks = blocks[low] != blocks_b[low]
                for at in range(0, high - low, BLOCK):
                    i, j = np.nonzero(x[at : at + BLOCK] @ x.T >= threshold)
                    i = i + at
                    new = (s[i] != s[j]) if two_blocks else (i != j)
                    i, j = i[new], j[new]
                    for earlier in range(int(t[low])):
                        fresh = keys[i, earlier] != keys[j, earlier]
                        i, j = i[fresh], j[fresh]
                    np.add.at(linked, i, copies[low:high][j])
                    once = i < j
                    label = local_roots(high - low, i[once], j[once])
                    moved = np.flatnonzero(label != np.arange(high - low))
                    a.append(moved)
                    b.append(label[moved])
                label = local_roots(high - low, np.concatenate(a), np.concatenate(b))
                ids = node[low:high]
                hit = np.flatnonzero((linked > 0) | (label != np.arange(high - low)))
                if len(hit):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[hit]), pa.array(linked[hit]), pa.array(ids[label[hit]])],
                        ["node", "linked", "other"],
                    )

    return dealt(tasks, ["size", "t", "key"]).mapInArrow(run, "node long, linked long, other long")


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    id_column: str = "vec_id",
    vector: str = "embedding",
    cap: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``."""
    work = Workspace(vectors.sparkSession, "vectors")
    narrow = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    # -0.0 and 0.0 are one value to the grouping; products are in double precision whatever is stored.
    kind = narrow.schema["vector"].dataType.elementType.simpleString()
    kind = kind if kind == "float" else "double"
    plain = F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x).cast(kind))
    able = narrow.filter(sane(F.col("vector"))).select("vec_id", plain.alias("vector"))
    classes = work.write(
        able.groupBy("vector")
        .agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
        .select(
            F.xxhash64("vector").alias("node"),
            "low",
            "copies",
            F.size("vector").alias("size"),
            "vector",
        ),
        "classes",
    )
    bits, n_tables = plan_tables(classes.count(), threshold, recall)
    hashed = work.write(_hashed(classes, bits, n_tables), "hashed")
    members = hashed.select("node", "size", F.posexplode("keys").alias("t", "key"))
    # Blocks are dealt on narrow rows; the vectors join once the tasks are known.
    tasks = block_tasks(work, members, ["size", "t", "key"], "node", cap).join(
        hashed.select("node", "copies", "vector", "signs"), "node"
    )
    links = work.write(_links(tasks, threshold, bits, n_tables), "links")
    roots = connected(work, links, "node", "other")
    counts = links.groupBy("node").agg(F.sum("linked").alias("linked"))
    labelled = (
        classes.join(counts, "node", "left")
        .join(roots, "node", "left")
        .select(
            "vector",
            "low",
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("root"),
        )
    )
    lows = labelled.groupBy("root").agg(F.min("low").alias("component_id"))
    named = work.write(labelled.join(lows, "root").select("vector", "n_links", "component_id"), "named")
    joined = able.join(named, "vector").select("vec_id", "n_links", "component_id")
    alone = narrow.filter(~sane(F.col("vector"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return joined.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
