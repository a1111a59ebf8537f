"""Tail probabilities, the choice of drift tests, stored profiles and the delivery budget against plain versions."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from hemline.functions import tails
from hemline.operators import drift, inventory, profiles


def values(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema).withColumn("i", F.monotonically_increasing_id())
    return [r[0] for r in df.select(column, "i").orderBy("i").collect()]


def test_error_function(spark):
    xs = [0.0, 1e-9, 0.1, 0.7, 1.5, 2.4999, 2.5, 3.0, 5.0, 9.0, 30.0]
    got = values(spark, [(x,) for x in xs], "x double", tails.erfc(F.col("x")))
    assert got == pytest.approx([math.erfc(x) for x in xs], rel=1e-11, abs=1e-300)
    two = values(spark, [(x,) for x in xs], "x double", tails.normal_two_sided(-F.col("x")))
    assert two == pytest.approx([math.erfc(x / math.sqrt(2)) for x in xs], rel=1e-11, abs=1e-300)


def chi_square(x, dof):
    """Upper tail by numerical integration of the density."""
    a, n = dof / 2, 200_000
    top = x + 60 + 12 * math.sqrt(2 * dof) + dof
    step = (top - x) / n
    f = lambda t: math.exp((a - 1) * math.log(t) - t / 2 - a * math.log(2) - math.lgamma(a)) if t > 0 else 0.0
    return step / 3 * sum((1 if i in (0, n) else 4 if i % 2 else 2) * f(x + i * step) for i in range(n + 1))


def test_chi_square_tail(spark):
    cases = [(3.841458820694124, 1), (0.5, 1), (5.991464547107979, 2), (0.1, 3), (36.415, 24), (11.0, 5), (250.0, 200), (1100.0, 1000), (40.0, 3)]
    got = values(spark, cases, "x double, k int", tails.chi_square_tail(F.col("x"), F.col("k")))
    assert got == pytest.approx([chi_square(x, k) for x, k in cases], rel=1e-6)
    assert got[0] == pytest.approx(0.05, rel=1e-9) and got[2] == pytest.approx(0.05, rel=1e-9)
    assert values(spark, [(0.0, 4), (-1.0, 2)], "x double, k int", tails.chi_square_tail(F.col("x"), F.col("k"))) == [1.0, 1.0]


def exact_ks(d, n, m):
    """Share of all orders of two samples with a gap of d or more, by counting paths."""
    ways = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            if abs(Fraction(i, n) - Fraction(j, m)) < d:
                ways[i][j] = 1 if i == j == 0 else (ways[i - 1][j] if i else 0) + (ways[i][j - 1] if j else 0)
    return 1 - Fraction(ways[n][m], math.comb(n + m, n))


def test_kolmogorov_tails(spark):
    for n, m in ((3, 4), (7, 7), (12, 30), (25, 9)):
        for k in range(1, n * m + 1, 5):
            d = Fraction(k, n * m)
            assert drift.ks_exact_tail(float(d), n, m) == pytest.approx(float(exact_ks(d, n, m)), abs=1e-9)
    cases = [(0.3, 40, 60), (0.2, 100, 80), (0.1, 300, 500), (0.45, 20, 25)]
    got = values(spark, cases, "d double, n long, m long", tails.ks_tail(F.col("d"), F.col("n"), F.col("m")))
    assert got == pytest.approx([drift.ks_exact_tail(*c) for c in cases], abs=0.02)
    assert values(spark, [(0.3,), (1.3580986,), (0.0,)], "x double", tails.kolmogorov_tail(F.col("x"))) == pytest.approx([0.99999069, 0.05, 1.0], abs=1e-6)


def test_method_by_type_values_and_size(spark):
    rnd = random.Random(2)

    def side(n, shift):
        rows = [(rnd.gauss(shift, 1), float(rnd.randrange(4)), rnd.choice(["a", "b"] if rnd.random() > shift / 4 else ["a"]), rnd.choice("pqrst"), None) for _ in range(n)]
        return spark.createDataFrame(rows, "x double, few double, two string, many string, none string")

    old, new = side(200, 0.0), side(300, 1.0)
    found = {r.column: r for r in drift.drift_auto(old, new, ["x", "few"], ["two", "many", "none"]).collect()}
    assert {c: r.method for c, r in found.items()} == {"x": "kolmogorov_smirnov", "few": "chi_square", "two": "share", "many": "chi_square", "none": "share"}
    assert found["x"].drifted and found["x"].p_value < 1e-6 and not found["none"].drifted
    n, m = 200, 300
    p, q = (df.filter("two = 'a'").count() / df.count() for df in (old, new))
    pooled = (p * n + q * m) / (n + m)
    z = abs(p - q) / math.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
    assert found["two"].statistic == pytest.approx(z) and found["two"].p_value == pytest.approx(math.erfc(z / math.sqrt(2)))
    old_counts, new_counts = ({r.many: r["count"] for r in df.groupBy("many").count().collect()} for df in (old, new))
    chi = sum((new_counts.get(k, 0) - c * m / n) ** 2 / (c * m / n) for k, c in old_counts.items())
    assert found["many"].statistic == pytest.approx(chi) and found["many"].p_value == pytest.approx(chi_square(chi, 4), rel=1e-5)
    large = {r.column: r.method for r in drift.drift_auto(side(1001, 0.0), new, ["x", "few"], ["many"]).collect()}
    assert large == {"x": "wasserstein", "few": "jensen_shannon", "many": "jensen_shannon"}
    assert {r.p_value for r in drift.drift_auto(old, old, ["x", "few"], ["two", "many"]).collect()} == {1.0}


def test_profiles_merge_and_compare_like_the_rows(spark):
    rnd = random.Random(5)
    rows = [(d, rnd.gauss(d / 3, 2) if rnd.random() > 0.05 else None, float(rnd.randrange(3)), rnd.choice("abc") if d < 5 else rnd.choice("abcd")) for d in range(8) for _ in range(900)]
    df = spark.createDataFrame(rows + [(9, float("nan"), None, None)], "day int, x double, few double, c string").repartition(5)
    stored = profiles.profiles(df, ["day"], ["x", "few"], ["c"])
    assert stored.filter("column = 'x'").count() == 9
    old, new = profiles.merged(stored.filter("day < 5")), profiles.merged(stored.filter("day >= 5"))
    a, b = df.filter("day < 5"), df.filter("day >= 5")
    found = {r.column: r for r in profiles.compared(old, new).collect()}
    for r in drift.drift_ks(a, b, ["x", "few"]).collect():
        assert abs(found[r.column].statistic - r.statistic) <= found[r.column].bound < 0.02
        assert (found[r.column].n_ref, found[r.column].n_cur, found[r.column].drifted) == (r.n_ref, r.n_cur, r.drifted)
    js = drift.drift_js(a, b, ["c"]).first()
    assert found["c"].statistic == pytest.approx(js.statistic) and found["c"].drifted == js.drifted
    assert found["x"].nulls_cur == b.filter("x IS NULL OR isnan(x)").count() and found["c"].nulls_cur == 1
    told = {r.column: r for r in profiles.summary(profiles.merged(stored)).collect()}
    want = df.filter("NOT isnan(x)").agg(F.avg("x"), F.stddev_pop("x"), F.min("x"), F.max("x"), F.count_distinct("x")).first()
    x = told["x"]
    assert (x["mean"], x.deviation, x.low, x.high) == pytest.approx(tuple(want)[:4]) and abs(x.n_distinct / want[4] - 1) < 0.05
    empty = profiles.compared(old, profiles.merged(stored.filter("day > 99"))).collect()
    assert all(r.drifted and r.statistic is None for r in empty)


def test_profiles_follow_from_counted_values(spark):
    rows = [(d, v, c) for d in (1, 2, None) for v, c in ((1.5, "a"), (1.5, None), (float("nan"), "b"), (None, "b"), (4.0, "a"))]
    df = spark.createDataFrame(rows, "day int, x double, c string")
    counts = profiles.counted(df, ["day"], ["x"], ["c"])
    assert "Expand" not in counts._jdf.queryExecution().executedPlan().toString()
    stored = profiles.profiles(df, ["day"], ["x"], ["c"], counts=counts)
    x = {r.day: (r.n, r.nulls, r.total, r.squares, r.low, r.high) for r in stored.filter("column = 'x'").collect()}
    assert x == {d: (3, 2, 7.0, 20.5, 1.5, 4.0) for d in (1, 2, None)}
    labels = {(r.day, r.label): (r.n, r.nulls) for r in stored.filter("column = 'c'").collect()}
    assert labels == {(d, c): n for d in (1, 2, None) for c, n in (("a", (2, 0)), ("b", (2, 0)), (None, (0, 1)))}
    older = F.col("day") < 2
    for kind, column, dtype in ((profiles.NUMBERS, "x", "double"), (profiles.LABELS, "c", "string")):
        want = drift.value_counts(df.filter(older), df.filter(~older), [column], dtype)
        assert sorted(map(tuple, profiles.sides(counts, older, kind).collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("budget", [0, 1, 17, 60, 10_000])
def test_budget_goes_to_the_most_useful_units(spark, budget):
    rnd = random.Random(3)
    rows = []
    for i in range(40):
        low = rnd.randrange(-2, 9)
        rows.append((str(i % 13), i % 4 + i // 26 * 10, rnd.randrange(-3, 9), None if i == 5 else low, None if i == 5 else low + rnd.choice([0, 0, 1, 3, 8]), rnd.randrange(1, 4)))
    orders = spark.createDataFrame(rows, "external_code string, retail int, accumulated_inventory int, lo_ci int, hi_ci int, price int")
    assert orders.select("external_code", "retail").distinct().count() == 40
    units = []
    for code, retail, have, low, high, price in rows:
        if high is not None:
            width = max(high - low, 1)
            units += [(-(10**6 * min(width, high - have - k + 1) * price // width), code, retail, k) for k in range(1, high - have + 1)]
    want = {}
    for _, code, retail, _ in sorted(units)[:budget]:
        want[code, retail] = want.get((code, retail), 0) + 1
    got = inventory.reorder_budget(orders, budget, value=F.col("price")).collect()
    assert len(got) == 40 and {(r.external_code, r.retail): r.granted for r in got if r.granted} == want
    assert sum(r.granted for r in got) == min(budget, len(units))
