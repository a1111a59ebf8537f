"""Column profiles that are kept as rows and merged without the data they came from.

A profile of a batch has, for each numeric column, counts, sums and two mergeable sketches: of quantiles (KLL) and of distinct values
(HyperLogLog). For a category it has the exact count of each label, which merges by adding. Profiles of batches (days, say) are written
once; a reference is merged from any of them when it is needed, so drift is found without reading the reference rows again.

A KLL sketch of parameter k gives ranks to within about 2.3 / k^0.9 of all rows, whatever their number (1.3 % for k = 300); a merge keeps
that bound. The largest gap of two cumulative distributions therefore differs by at most twice it from the exact one, plus two steps of the
grid it is looked for on. ``compared`` says so in its column ``bound``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemline.operators.drift import DISTANCE_LIMIT, KS_P_LIMIT, number
from hemline.operators.joins import null_safe_join
from hemline.functions.tails import ks_tail

K = 1000
#: Ranks at which two sketches are compared, from either side.
GRID = 200
LABELS = "labels"
NUMBERS = "numbers"


def rank_error(k: int = K) -> float:
    """Bound of a rank from a KLL sketch, as a share of all rows."""
    return 2.3 / k**0.9


def counted(df: DataFrame, by: list[str], numeric: list[str], categorical: list[str]) -> DataFrame:
    """(by, column, kind, value, label, rows): how many rows of a batch have each number (or label), NULL among them; NaN is NULL.

    A column is read and counted on its own, without a row per column: for a stored table of columns that is one reading in all.
    """
    parts = []
    for c in [*numeric, *categorical]:
        own = c in numeric
        value, label = (number(c), F.lit(None).cast("string")) if own else (F.lit(None).cast("double"), F.col(c).cast("string"))
        named = df.select(*by, (value if own else label).alias("_own")).groupBy(*by, "_own").agg(F.count("*").alias("rows"))
        value, label = (F.col("_own"), label) if own else (value, F.col("_own"))
        kind = F.lit(NUMBERS if own else LABELS)
        parts.append(named.select(*by, F.lit(c).alias("column"), kind.alias("kind"), value.alias("value"), label.alias("label"), "rows"))
    return reduce(DataFrame.unionByName, parts)


def sides(counts: DataFrame, older: Column, kind: str) -> DataFrame:
    """(column, value, ref, cur) of :func:`counted`, as ``drift.value_counts`` has them: batches that are ``older`` are the reference, those
    that are not the current side, and those of which that is not known neither."""
    value = "value" if kind == NUMBERS else "label"
    known = counts.filter((F.col("kind") == kind) & F.col(value).isNotNull() & older.isNotNull())
    ref, cur = (F.sum(F.when(side, F.col("rows")).otherwise(0)).alias(name) for name, side in (("ref", older), ("cur", ~older)))
    return known.groupBy("column", F.col(value).alias("value")).agg(ref, cur)


def profiles(
    df: DataFrame, by: list[str], numeric: list[str], categorical: list[str], k: int = K, counts: DataFrame | None = None
) -> DataFrame:
    """One row per batch and column, for categories one per label: (by, column, kind, label, n, nulls, total, squares, low, high,
    quantiles, distinct).

    NaN counts as missing. ``by`` names the batch. ``counts`` is :func:`counted` of the same columns, given where it is stored already. The
    sketches of quantiles take every row, those of all columns in one pass; the sums and the sketches of distinct values follow from the counts.
    """
    empty = F.lit(None)
    counts = counted(df, by, numeric, categorical) if counts is None else counts
    parts = []
    if numeric:
        value, rows = F.col("value"), F.col("rows")
        known = F.when(value.isNotNull(), rows).otherwise(0)
        sums = counts.filter(F.col("kind") == NUMBERS).groupBy(*by, "column").agg(
            F.sum(known).alias("n"),
            F.sum(rows - known).alias("nulls"),
            F.sum(value * rows).alias("total"),
            F.sum(value * value * rows).alias("squares"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            F.hll_sketch_agg(value.cast("string")).alias("distinct"),
        )
        sketched = df.groupBy(*by).agg(*[F.kll_sketch_agg_double(number(c), k).alias(c) for c in numeric]).unpivot(by, numeric, "column", "quantiles")
        parts.append(
            null_safe_join(sums, sketched, [*by, "column"], "inner").withColumns({"kind": F.lit(NUMBERS), "label": empty.cast("string")})
        )
    if categorical:
        missing = F.col("label").isNull()
        labels = counts.filter(F.col("kind") == LABELS).select(
            *by, "column", "label", F.when(missing, 0).otherwise(F.col("rows")).alias("n"), F.when(missing, F.col("rows")).otherwise(0).alias("nulls")
        )
        none = {c: empty.cast("double") for c in ("total", "squares", "low", "high")} | {c: empty.cast("binary") for c in ("quantiles", "distinct")}
        parts.append(labels.withColumns({"kind": F.lit(LABELS), **none}))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select(*by, "column", "kind", "label", "n", "nulls", "total", "squares", "low", "high", "quantiles", "distinct")


def merged(stored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The profiles of several batches as one, or as one for each value of ``by``."""
    by = by or []
    return stored.groupBy(*by, "column", "kind", "label").agg(
        *[F.sum(c).alias(c) for c in ("n", "nulls", "total", "squares")],
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def summary(profile: DataFrame) -> DataFrame:
    """(column, n, nulls, mean, deviation, low, high, n_distinct) per numeric column; distinct values are estimated."""
    mean = F.try_divide("total", "n")
    spread = F.sqrt(F.greatest(F.try_divide("squares", "n") - mean * mean, F.lit(0.0)))
    return profile.filter(F.col("kind") == NUMBERS).select(
        "column", "n", "nulls", mean.alias("mean"), spread.alias("deviation"), "low", "high", F.hll_sketch_estimate("distinct").alias("n_distinct")
    )


def _gap(reference: Column, current: Column) -> Column:
    """Largest gap of the ranks at the quantiles of both sketches. A rank is the share of a side's quantiles up to the point."""
    at = F.array(*[F.lit(i / GRID) for i in range(1, GRID + 1)])
    sides = F.struct(F.kll_sketch_get_quantile_double(reference, at).alias("r"), F.kll_sketch_get_quantile_double(current, at).alias("c"))

    def widest(own: Column) -> Column:
        def rank(side: str, point: Column) -> Column:
            return F.size(F.filter(own[side], lambda v: v <= point)) / F.lit(float(GRID))

        points = F.array_distinct(F.concat(own["r"], own["c"]))
        return F.array_max(F.transform(points, lambda x: F.abs(rank("r", x) - rank("c", x))))

    return F.transform(F.array(sides), widest)[0]


def compared(reference: DataFrame, current: DataFrame, k: int = K) -> DataFrame:
    """Drift of two profiles, one row per column: (column, method, statistic, bound, p_value, drifted, n, nulls and mean of both sides).

    Numbers by the largest gap of their distributions, within ``bound`` of the exact one; labels by the Jensen-Shannon distance, which
    is exact.
    """
    sides = []
    for frame, side in ((reference, "ref"), (current, "cur")):
        own = frame.filter(F.col("kind") == NUMBERS)
        sides.append(
            own.select(
                "column", F.col("n").alias(f"n_{side}"), F.col("nulls").alias(f"nulls_{side}"),
                F.try_divide("total", "n").alias(f"mean_{side}"), F.col("quantiles").alias(f"q_{side}"),
            )
        )
    known = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    numbers = sides[0].join(sides[1], "column", "full").withColumn("statistic", F.when(known, _gap(F.col("q_ref"), F.col("q_cur"))))
    p = F.when(known, ks_tail(F.col("statistic"), F.col("n_ref"), F.col("n_cur")))
    numbers = numbers.select(
        "column", F.lit("kolmogorov_smirnov").alias("method"), "statistic", F.lit(2 * rank_error(k) + 2 / GRID).alias("bound"), p.alias("p_value"),
        F.coalesce(p < KS_P_LIMIT, F.lit(True)).alias("drifted"), "n_ref", "n_cur", "nulls_ref", "nulls_cur", "mean_ref", "mean_cur",
    )
    return numbers.unionByName(_labels_compared(reference, current))


def _labels_compared(reference: DataFrame, current: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    both = None
    for frame, ref, cur in ((reference, F.col("n"), zero), (current, zero, F.col("n"))):
        nulls = (F.col("nulls"), zero) if both is None else (zero, F.col("nulls"))
        part = frame.filter(F.col("kind") == LABELS).select(
            "column", "label", ref.alias("ref"), cur.alias("cur"), nulls[0].alias("nulls_ref"), nulls[1].alias("nulls_cur")
        )
        both = part if both is None else both.unionByName(part)
    counted = both.groupBy("column", "label").agg(*[F.sum(c).alias(c) for c in ("ref", "cur", "nulls_ref", "nulls_cur")])
    totals = counted.groupBy("column").agg(
        F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"), F.sum("nulls_ref").alias("nulls_ref"), F.sum("nulls_cur").alias("nulls_cur")
    )
    rows = counted.drop("nulls_ref", "nulls_cur").join(totals, "column")
    p, q = F.try_divide("ref", "n_ref"), F.try_divide("cur", "n_cur")

    def part(own: Column) -> Column:
        return F.when(own > 0, own * F.ln(own * 2 / (p + q))).otherwise(0.0)

    found = rows.groupBy("column", "n_ref", "n_cur", "nulls_ref", "nulls_cur").agg(F.sqrt(F.greatest(F.lit(0.0), F.sum(part(p) + part(q)) / 2)).alias("distance"))
    known = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    statistic = F.when(known, F.col("distance"))
    return found.select(
        "column", F.lit("jensen_shannon").alias("method"), statistic.alias("statistic"), F.lit(1e-9).alias("bound"), F.lit(None).cast("double").alias("p_value"),
        F.coalesce(statistic >= DISTANCE_LIMIT, (F.col("n_ref") > 0) | (F.col("n_cur") > 0)).alias("drifted"), "n_ref", "n_cur", "nulls_ref", "nulls_cur",
        F.lit(None).cast("double").alias("mean_ref"), F.lit(None).cast("double").alias("mean_cur"),
    )
