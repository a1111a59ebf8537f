"""The live ledger against the batch one, and vectors reduced to their leading directions."""

import datetime as dt
import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hemline.operators import inventory, reduction
from hemline.streaming import jobs, ledger, sinks

SALES = "external_code string, retail int, week int, year int, date date, sales int, restock int"
EVENTS = "external_code string, retail int, week int, year int, qty int"
COLUMNS = [c.split()[0] for c in ledger.BALANCES.split(", ")]


def series(rnd, code, retail):
    """Sales with repeated dates, gaps and nulls, and events before, in and after their weeks."""
    sales, events = [], []
    for w in range(rnd.randrange(1, 9)):
        day = dt.date(2019, 12, 2) + dt.timedelta(7 * w)
        for _ in range(rnd.choice([0, 1, 1, 2])):
            week = rnd.choice([w + 40, w + 40, None])
            sales.append((code, retail, week, day.year if week else None, rnd.choice([day] * 6 + [None]), rnd.choice([None, 0, 3, 5]), rnd.choice([None, 7, 20])))
        for _ in range(rnd.choice([0, 0, 1, 2])):
            events.append((code, retail, w + 40, day.year, rnd.choice([None, 1, 4, 9])))
    return sales, events


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    made = [series(rnd, rnd.choice(["1", "2", "é", None]), s) for s in [*range(25), None]]
    return [r for s, _ in made for r in s], [r for _, e in made for r in e]


def test_three_rounds_equal_the_batch_ledger(spark, tmp_path, rows):
    sales, events = spark.createDataFrame(rows[0], SALES), spark.createDataFrame(rows[1], EVENTS)
    base = str(tmp_path)
    late = F.coalesce(F.col("week"), F.lit(40)) % 2 == 0
    rounds = [(sales.filter(late), events.filter("false")), (sales.filter(~late), events.filter(late)), (sales.filter("false"), events.filter(~late))]
    so_far = None
    for i, (sold, came) in enumerate(rounds):
        sold.write.mode("append").parquet(f"{base}/sales")
        came.write.mode("append").parquet(f"{base}/restock")
        streams = [jobs.stream_files(spark, f"{base}/{n}") for n in ("sales", "restock")]
        ledger.run_live_ledger(*streams, f"{base}/balances", f"{base}/state", timeout=300)
        so_far = (sold, came) if so_far is None else tuple(a.unionByName(b) for a, b in zip(so_far, (sold, came), strict=True))
        found = ledger.newest(sinks.read_merged(spark, f"{base}/balances"))
        want = inventory.stock_ledger(*so_far)
        assert plain(found.select(COLUMNS).collect()) == plain(want.select([F.col(c).cast(k) for c, k in (x.split() for x in ledger.BALANCES.split(", "))]).collect()), i
    before = sinks.read_merged(spark, f"{base}/balances").count()
    streams = [jobs.stream_files(spark, f"{base}/{n}") for n in ("sales", "restock")]
    ledger.run_live_ledger(*streams, f"{base}/balances", f"{base}/state", timeout=300)
    assert sinks.read_merged(spark, f"{base}/balances").count() == before


def test_a_series_without_sales_has_no_balance():
    assert ledger.balances({(False, 40, 2019, None): [None, None, 5]}, True) == []
    one = {(True, 40, 2019, "2019-10-01"): [2, 9, None], (False, 40, 2019, None): [None, None, 5]}
    assert ledger.balances(one, True) == [(40, 2019, "2019-10-01", 2, 5, 3)]
    assert ledger.balances(one, False) == [(40, 2019, "2019-10-01", 2, 0, -2)]


def test_one_call_takes_the_rows_of_many_series(monkeypatch):
    class State(dict):
        def getValue(self, key):
            return self.get(key)

        def updateValue(self, key, value):
            self[key] = value

    class Handle:
        def getMapState(self, *_):
            return state

    state = State()
    monkeypatch.setattr(ledger, "SERIES_A_FRAME", 2)
    processor = ledger.SeriesBalance()
    processor.init(Handle())
    names = [json.dumps({"external_code": "a", "retail": i}) for i in range(3)]
    sold = [(n, True, 40, 2019, dt.date(2019, 10, 1), 2 + i, 9, None) for i, n in enumerate(names)]
    came = [(names[1], False, 40, 2019, None, None, None, 5)]
    first = list(processor.handleInputRows((7,), iter([pd.DataFrame(sold[:2], columns=ledger._EVENTS), pd.DataFrame(sold[2:], columns=ledger._EVENTS)]), None))
    assert [len(f) for f in first] == [2, 1] and set(state) == {(n,) for n in names}
    assert [tuple(r) for f in first for r in f.itertuples(index=False)] == [("a", i, 40, 2019, dt.date(2019, 10, 1), 2 + i, 9, 1, 7 - i) for i in range(3)]
    kept = dict(state)
    (later,) = processor.handleInputRows((7,), iter([pd.DataFrame(came, columns=ledger._EVENTS)]), None)
    assert [tuple(r) for r in later.itertuples(index=False)] == [("a", 1, 40, 2019, dt.date(2019, 10, 1), 3, 5, 1, 2)]
    assert {n for n in state if state[n] != kept[n]} == {(names[1],)}


def test_directions_equal_an_eigendecomposition(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3)) @ rng.normal(size=(3, 6)) + rng.normal(scale=0.01, size=(300, 6)) + 5
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())] + [(999, None)], "i int, v array<double>").repartition(4)
    made = reduction.fit_reduction(df, "v", 3)
    assert made.rows == 300 and made.mean == pytest.approx(x.mean(axis=0))
    assert made.variances == pytest.approx(np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1])
    assert made.residual(df, "v") == pytest.approx(made.variances[3:].sum(), abs=1e-9)
    got = {r["i"]: r["v"] for r in made.transform(df, "v").collect()}
    assert got[999] is None and all(len(got[i]) == 3 for i in range(300))
    back = np.array([got[i] for i in range(300)]) @ made.directions + made.mean
    assert np.abs(back - x).max() < 0.1
    assert np.var([got[i] for i in range(300)], axis=0) == pytest.approx(made.variances[:3])
    with pytest.raises(ValueError, match="no vector"):
        reduction.fit_reduction(df.filter("v IS NULL"), "v", 2)
