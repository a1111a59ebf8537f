"""Exact ranks, running counts and quantiles without a global sort.

Values are first counted per group with a map-side aggregate. The counted rows are dealt to partitions by
ranges of (group, value) and written once with the number of their partition; the ranges are sampled, so
every later step reads the written numbers. Running counts are built inside each (group, partition) and shifted by
the totals of the partitions before it. A group with all the rows is spread over as many partitions as many
small ones are, and the number of partitions follows Spark's setting and the data, with no bound of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemline.operators.joins import null_safe_join
from hemline.session import written

PART = "_part"


def ranged(df: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """``df`` with the number of its range of ``order`` in ``_part``, written.

    ``parts`` is the number of ranges; without it Spark's shuffle setting and adaptive execution decide.
    """
    dealt = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return written(dealt.withColumn(PART, F.spark_partition_id()), "ranged")


def running_counts(
    counted: DataFrame, by: list[str], value: str, weights: list[str], parts: int | None = None
) -> DataFrame:
    """Adds ``cum_{w}`` (up to and including the row) and ``total_{w}`` for every weight, and
    ``next_value``, the next larger value of the group.

    ``counted`` has one row per group and value, without NULL values.
    """
    dealt = ranged(counted, [*by, value], parts)
    per_part = dealt.groupBy(*by, PART).agg(
        *[F.sum(w).alias(f"_sum_{w}") for w in weights], F.min(value).alias("_first")
    )
    # One row per group and partition it touches.
    group = Window.partitionBy(*by)
    in_order = group.orderBy(PART)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        *by,
        PART,
        *[F.coalesce(F.sum(f"_sum_{w}").over(earlier), F.lit(0)).alias(f"_before_{w}") for w in weights],
        *[F.sum(f"_sum_{w}").over(group).alias(f"total_{w}") for w in weights],
        F.lead("_first").over(in_order).alias("_next_first"),
    )
    cell = Window.partitionBy(*by, PART).orderBy(value)
    return (
        null_safe_join(dealt, offsets, [*by, PART], "inner")
        .withColumns(
            {
                **{f"cum_{w}": F.col(f"_before_{w}") + F.sum(w).over(cell) for w in weights},
                "next_value": F.coalesce(F.lead(value).over(cell), F.col("_next_first")),
            }
        )
        .drop(PART, "_next_first", *[f"_before_{w}" for w in weights])
    )


def order_statistics(
    df: DataFrame,
    by: list[str],
    value: str,
    ranks: dict[str, Callable[[Column], Column]],
    parts: int | None = None,
) -> DataFrame:
    """The k-th smallest value per group, for several k at once.

    ``ranks`` maps an output name to a function from the group's row count to a rank. A rank beyond the
    row count gives NULL. ``n`` holds the row count.
    """
    counted = (
        df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    )
    ranked = running_counts(counted, by, value, ["_n"], parts)
    total, upto = F.col("total__n"), F.col("cum__n")
    picked = [
        F.max(F.when((upto - F.col("_n") < rank(total)) & (rank(total) <= upto), F.col(value))).alias(name)
        for name, rank in ranks.items()
    ]
    return ranked.groupBy(*by).agg(F.max(total).alias("n"), *picked)


def exact_median(df: DataFrame, by: list[str], value: str, name: str = "median") -> DataFrame:
    """Median per group; the mean of the two middle values for an even count."""
    middle = order_statistics(
        df,
        by,
        value,
        {"_lo": lambda n: F.floor((n + 1) / 2), "_hi": lambda n: F.floor(n / 2) + 1},
    )
    return middle.select(*by, ((F.col("_lo") + F.col("_hi")) / 2).alias(name))
