"""Wide to long, and arrays to rows or columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

N_WEEKS = 12


def week_columns(n_weeks: int = N_WEEKS) -> list[str]:
    return [str(i) for i in range(n_weeks)]


def unpivot_weeks(
    df: DataFrame, ids: list[str], value: str, week: str = "week", n_weeks: int = N_WEEKS
) -> DataFrame:
    """One row per id and week column. A narrow operation: no shuffle, also valid on a stream."""
    return df.unpivot([F.col(c) for c in ids], [F.col(c) for c in week_columns(n_weeks)], week, value)


def explode_weeks(
    df: DataFrame, ids: list[str], value: str, week: str = "week", n_weeks: int = N_WEEKS
) -> DataFrame:
    """The rows of :func:`unpivot_weeks`, left where the wide row was: what follows by the keys that ``df`` is
    partitioned by needs no exchange."""
    rows = [F.struct(F.lit(c).alias(week), F.col(c).alias(value)) for c in week_columns(n_weeks)]
    return df.select(*ids, F.inline(F.array(*rows)))


def explode_embedding(df: DataFrame, keys: list[str], embed: str = "embed") -> DataFrame:
    """One row per vector element, with its position."""
    return df.select(*keys, F.posexplode(embed).alias("position", "embed_value"))


def embedding_columns(
    df: DataFrame, keys: list[str], size: int, embed: str = "embed", prefix: str = "embed_"
) -> DataFrame:
    """One column per vector element, numbered from 1; NULL past the end of a short vector. A longer vector is an
    error."""
    vector = F.when(
        F.size(embed) > size, F.raise_error(F.lit(f"a vector of {embed} has more than {size} elements"))
    ).otherwise(F.col(embed))
    return df.withColumn(embed, vector).select(
        *keys, *[F.get(F.col(embed), F.lit(i)).alias(f"{prefix}{i + 1}") for i in range(size)]
    )
