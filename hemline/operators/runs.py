"""A table of training runs and the choice of the best one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def run_rows(
    spark: SparkSession, run_id: str, params: dict[str, object], metrics: dict[str, float]
) -> DataFrame:
    text = {k: str(v) for k, v in params.items()}
    rows = [(run_id, text, name, float(value)) for name, value in metrics.items()]
    return spark.createDataFrame(rows, RUNS)


def log_run(rows: DataFrame, path: str) -> None:
    """Append to the runs table. One writer kind only: batch appends."""
    rows.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def best_run(
    runs: DataFrame, metric: str, below: float | None = None, smallest: bool = True
) -> DataFrame:
    """The best run of a metric, optionally only among values below a limit."""
    kept = runs.filter(F.col("metric") == metric)
    if below is not None:
        kept = kept.filter(F.col("value") < below)
    order = F.asc("value") if smallest else F.desc("value")
    return kept.orderBy(order, "run_id").limit(1)


def best_score(history: DataFrame, by: list[str] | None = None, score: str = "score") -> DataFrame:
    """Smallest score per group and the iteration that reached it first."""
    return history.groupBy(*(by or [])).agg(
        F.min(score).alias("best_score"),
        F.min(F.struct(F.col(score), F.col("iterations"))).getField("iterations").alias("best_iteration"),
    )
