"""The stock ledger kept live: balances of a series are worked out anew when its events arrive.

Sales rows and restock events are one stream, dealt by item and store. The state of a series is what the ledger reduces it to: one row per
date and week with the smallest figures, so it is bounded by the calendar and not by the events. When rows of a series arrive, however
late, its state takes them in and all its balances are given out again; readers keep the newest ones (:func:`newest`).
Equal to ``inventory.stock_ledger`` of all rows that have come.

Series are dealt to ``BUCKETS`` by a hash, and a call of the processor takes the new rows of a bucket: its fixed cost, many times that of one
series' balances, is paid per bucket. The state of a bucket is a map with an entry per series, of which only those with new rows are touched.

Needs Spark's RocksDB state store, whose state survives lost executors in the checkpoint (``state_settings``).
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from itertools import batched

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hemline.operators.inventory import ITEM_STORE
from hemline.streaming.sinks import BATCH_COLUMN, each_batch, write_batch

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BALANCES = "external_code string, retail int, week int, year int, date date, sales long, qty long, row int, accumulated_inventory long"
BUCKETS = 1024
#: Series whose balances make one frame.
SERIES_A_FRAME = 2000
_EVENTS = ["series", "is_sale", "week", "year", "date", "sales", "restock", "event_qty"]


def state_settings(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


def _taken(held: dict[tuple, list], place: tuple, figures: list) -> None:
    """Takes figures into the reduced rows of a series."""
    held[place] = [_least(a, b) for a, b in zip(held.get(place, [None] * 3), figures, strict=True)]


def _nulls_last(*values) -> tuple:
    return tuple((v is None, v if v is not None else 0) for v in values)


def balances(rows: dict[tuple, list], known_series: bool) -> list[tuple]:
    """(week, year, date, sales, qty, balance) of a series, from its reduced rows.

    ``rows`` maps (is_sale, week, year, date) to the smallest (sales, restock, event_qty); dates are ISO texts. The rules are those of
    ``inventory.first_match`` and the running sum by week.
    """
    sold = [(week, year, date, *figures) for (is_sale, week, year, date), figures in rows.items() if is_sale]
    inflow: dict[tuple, int] = {}
    for (_, week, year, _), (_, _, qty) in rows.items():
        if qty is not None:
            inflow[week, year] = _least(inflow.get((week, year)), qty)
    if not sold:
        return []
    # The opening row: dated before undated, then date, week, known and smaller quantity, year; Spark sorts a null first.
    opening = min(sold, key=lambda r: (r[2] is None, r[2] or "", r[0] is not None, r[0] or 0, r[4] is None, r[4] or 0, r[1] is not None, r[1] or 0))
    picked: dict[str | None, tuple] = {}
    for week, year, date, sales, _, _ in sold:
        qty = None
        if known_series and week is not None and year is not None:
            qty = inflow.get((week, year))
            if (week, year) == (opening[0], opening[1]):
                qty = _least(qty, opening[4] if opening[4] is not None else 0)
        row = (qty or 0, week, year, sales)
        order = (row[0], *_nulls_last(week, sales))
        if date not in picked or order < picked[date][0]:
            picked[date] = order, row
    out, total = [], None
    for at in sorted({r[1] for _, r in picked.values()}, key=lambda w: (w is not None, w or 0)):
        own = [(date, r) for date, (_, r) in picked.items() if r[1] == at]
        changes = [r[0] - r[3] for _, r in own if r[3] is not None]
        total = (total or 0) + sum(changes) if changes else total
        out += [(week, year, date, sales, qty, total) for date, (qty, week, year, sales) in own]
    return out


class SeriesBalance(StatefulProcessor):
    """Keeps the reduced rows of the items and stores of a bucket."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getMapState("series", "series string", "rows string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came: dict[str, dict[tuple, list]] = {}
        for frame in rows:
            plain = frame[_EVENTS].astype(object).where(frame[_EVENTS].notna(), None)
            for name, is_sale, week, year, date, *figures in plain.itertuples(index=False):
                place = (bool(is_sale), *(None if x is None else int(x) for x in (week, year)), None if date is None else str(date)[:10])
                _taken(came.setdefault(name, {}), place, [None if x is None else int(x) for x in figures])
        for names in batched([*came], SERIES_A_FRAME):
            made = [row for name in names for row in self._balances(name, came.pop(name))]
            out = pd.DataFrame(made, columns=[c.split()[0] for c in BALANCES.split(", ")], dtype=object)
            if len(out):
                yield out

    def _balances(self, name: str, came: dict[tuple, list]) -> Iterator[tuple]:
        """Takes the new rows of a series into its state and gives all its balances."""
        known = self._state.getValue((name,))
        held = {tuple(k): v for k, v in json.loads(known[0])} if known else {}
        for place, figures in came.items():
            _taken(held, place, figures)
        self._state.updateValue((name,), (json.dumps([[list(k), v] for k, v in held.items()]),))
        series = json.loads(name)
        own = [series.get(c) for c in ITEM_STORE]
        for week, year, date, sales, qty, total in balances(held, None not in own):
            yield *own, week, year, None if date is None else dt.date.fromisoformat(date), sales, qty, 1, total

    def close(self) -> None:
        pass


def live_ledger(sales: DataFrame, restock: DataFrame) -> DataFrame:
    """The stream of balances of all series that got rows, from streams in the shape of the batch ledger's inputs."""
    sold = sales.select(
        *ITEM_STORE, F.lit(True).alias("is_sale"), "week", "year", "date", "sales", "restock", F.lit(None).cast("long").alias("event_qty")
    )
    events = restock.select(
        *ITEM_STORE, F.lit(False).alias("is_sale"), "week", "year", F.lit(None).cast("date").alias("date"),
        F.lit(None).cast("long").alias("sales"), F.lit(None).cast("long").alias("restock"), F.coalesce(F.col("qty"), F.lit(0)).alias("event_qty"),
    )
    kinds = {"retail": "int", "week": "int", "year": "int", "date": "date", "sales": "long", "restock": "long", "event_qty": "long"}
    rows = sold.unionByName(events).withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})
    # One text that is never null names a series: null parts of a grouping key are not told apart by the state.
    named = rows.withColumn("series", F.to_json(F.struct(*ITEM_STORE))).drop(*ITEM_STORE)
    dealt = named.withColumn("bucket", F.pmod(F.xxhash64("series"), F.lit(BUCKETS)).cast("int"))
    return dealt.groupBy("bucket").transformWithStateInPandas(SeriesBalance(), BALANCES, "Update", "None")


def run_live_ledger(sales: DataFrame, restock: DataFrame, target: str, checkpoint: str, timeout: float | None = None) -> None:
    """Drain what has come of both streams into the balances at ``target``."""
    state_settings(sales.sparkSession)
    each_batch(live_ledger(sales, restock), lambda batch, i: write_batch(batch, i, target), checkpoint, timeout)


def newest(written: DataFrame) -> DataFrame:
    """The last balance of every item, store and date."""
    columns = [c for c in written.columns if c not in (*ITEM_STORE, "date", BATCH_COLUMN)]
    last = F.max(F.struct(BATCH_COLUMN, *columns)).alias("last")
    return written.groupBy(*ITEM_STORE, "date").agg(last).select(*ITEM_STORE, "date", *[f"last.{c}" for c in columns])
