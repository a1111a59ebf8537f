"""Buckets as tasks of bounded size.

Members of a bucket are compared with each other. A bucket of more than ``cap`` members is cut into blocks,
and each pair of blocks becomes a task, so no task holds more than two blocks, whatever the bucket's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemline.llm.common import Workspace


def block_tasks(work: Workspace, members: DataFrame, bucket: list[str], item: str, cap: int) -> DataFrame:
    """``members`` once per task: adds ``task_a`` <= ``task_b`` (blocks compared) and ``side`` (own block).

    ``item`` is what deals the members of a bucket to blocks. Buckets of one member are left out.
    """
    # Written first, so that both sides of the join are exchanged and Spark can split a large bucket.
    sizes = work.write(members.groupBy(*bucket).agg(F.count("*").alias("_n")).filter("_n > 1"), "bucket-sizes")
    n_blocks = F.ceil(F.col("_n") / F.lit(cap)).cast("int")
    own = F.pmod(F.xxhash64(F.col(item), F.lit(7)), F.col("_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return (
        members.join(sizes, bucket)
        .withColumn("_blocks", n_blocks)
        .withColumn("side", own)
        .withColumn("_other", other)
        .withColumn("task_a", F.least("side", "_other"))
        .withColumn("task_b", F.greatest("side", "_other"))
        .drop("_n", "_blocks", "_other")
    )


def dealt(tasks: DataFrame, bucket: list[str]) -> DataFrame:
    """Tasks' rows side by side in one partition each."""
    keys = [*bucket, "task_a", "task_b"]
    return tasks.repartition(*keys).sortWithinPartitions(*keys)


def task_runs(batches, bucket: list[str], most: int = 50_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole tasks, of about ``most`` rows, with the number of the task in each row."""
    keys, held = [*bucket, "task_a", "task_b"], []

    def numbered(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        for k in keys:
            column = table.column(k).to_numpy()
            new[1:] |= column[1:] != column[:-1]
        return np.cumsum(new)

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) < most:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        number = numbered(table)
        whole = int(np.searchsorted(number, number[-1]))
        if whole:
            yield table.slice(0, whole), number[:whole]
            held = table.slice(whole).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        if table.num_rows:
            yield table, numbered(table)
