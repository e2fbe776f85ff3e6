"""The stock-out rule over days that arrive in any order within a delay.

The rule is a recurrence: a day's corrected sales depend on those of the days before it. So the days of a SKU wait in its state
until the watermark has passed them, are then corrected in order, and go out once, never to be taken back. The state of a SKU
holds the days behind the watermark and the last ``window`` corrected ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CORRECTED = "sku bigint, sales_date date, total_sales_qty double, adjusted_qty double"
DAY_MS = 86_400_000


class StockoutProcessor(StatefulProcessor):
    """Days that wait, the last corrected days, the first day with a sale, and the day up to which all is final."""

    def __init__(self, window: int = 14, drop: float = 0.5, inv_frac: float = 0.3):
        self.window, self.drop, self.inv_frac = window, drop, inv_frac

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", "day int")
        self.done = handle.getValueState("done", "day int")
        self.recent = handle.getListState("recent", "day int, qty double, stock double")
        self.waiting = handle.getListState("waiting", "day int, qty double, stock double")

    def corrected(self, day: int, qty: float, stock: float, recent: list[tuple], first: int) -> float:
        stocks = [s for _, _, s in recent if s > 0]
        if np.isnan(stock) or day - first < self.window or len(stocks) < self.window / 2:
            return qty
        sold = [q for _, q, _ in recent if q > 0]
        mean = sum(sold) / self.window
        if not sold or stock >= np.mean(stocks) * self.inv_frac or (mean - qty) / mean <= self.drop:
            return qty
        return float(np.average(sold, weights=np.linspace(0.5, 1.0, len(sold)) if len(sold) > 1 else [1.0]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        done = self.done.get()[0] if self.done.exists() else None
        came = [r for part in rows for r in zip(part["day"].tolist(), part["qty"].tolist(), part["stock"].tolist()) if done is None or r[0] > done]
        return self.advance(key, [tuple(r) for r in self.waiting.get()] + came, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self.advance(key, [tuple(r) for r in self.waiting.get()], timerValues)

    def advance(self, key, rows: Iterable[tuple], timerValues) -> Iterator[pd.DataFrame]:
        """Correct the days that the watermark has passed; wake up again when it passes the next one."""
        days: dict[int, tuple[float, float]] = {}
        for day, qty, stock in rows:  # parts of a day add up, of several stock readings the largest counts
            qty_before, stock_before = days.get(day, (0.0, float("nan")))
            days[day] = (qty_before + qty, float(np.fmax(stock_before, stock)))
        final = timerValues.getCurrentWatermarkInMs() // DAY_MS - 1
        ready, later = sorted(d for d in days if d <= final), sorted(d for d in days if d > final)
        if later:
            self.waiting.put([(d, *days[d]) for d in later])
            self.handle.registerTimer((later[0] + 1) * DAY_MS)
        else:
            self.waiting.clear()
        if not self.done.exists() or self.done.get()[0] < final:
            self.done.update((final,))
        out = self.correct(ready, days)
        if out:
            yield pd.DataFrame(
                {
                    "sku": key[0],
                    "sales_date": pd.to_datetime([d for d, _, _ in out], unit="D").date,
                    "total_sales_qty": [q for _, q, _ in out],
                    "adjusted_qty": [a for _, _, a in out],
                }
            )

    def correct(self, ready: list[int], days: dict[int, tuple[float, float]]) -> list[tuple[int, float, float]]:
        """(day, sold, corrected) of the days in order, from the first day with a sale on."""
        first = self.first.get()[0] if self.first.exists() else next((d for d in ready if days[d][0] > 0), None)
        if first is None or not ready:
            return []
        recent = [tuple(r) for r in self.recent.get()]
        out = []
        for day in ready:
            if day < first:
                continue
            qty, stock = days[day]
            recent = [r for r in recent if r[0] >= day - self.window]
            fixed = self.corrected(day, qty, stock, recent, first)
            recent.append((day, fixed, stock))
            out.append((day, qty, fixed))
        self.first.update((first,))
        self.recent.put(recent)
        return out

    def close(self) -> None:
        pass


def stream_stockout(daily: DataFrame, delay: str, window: int = 14, drop: float = 0.5, inv_frac: float = 0.3) -> DataFrame:
    """Correct the days of each SKU (sku, sales_date, total_sales_qty, total_available_quantity), which may be ``delay`` late.

    A day comes out when later days of any SKU have moved the watermark past it. A row behind the days that are already out
    changes nothing. Needs the RocksDB state store (``ROCKSDB``) in the session.
    """
    rows = daily.select(
        "sku",
        F.col("sales_date").cast("timestamp").alias("ts"),
        F.unix_date("sales_date").alias("day"),
        F.col("total_sales_qty").cast("double").alias("qty"),
        F.coalesce(F.col("total_available_quantity").cast("double"), F.lit(float("nan"))).alias("stock"),
    )
    return (
        rows.withWatermark("ts", delay)
        .groupBy("sku")
        .transformWithStateInPandas(
            statefulProcessor=StockoutProcessor(window, drop, inv_frac), outputStructType=CORRECTED, outputMode="append", timeMode="EventTime"
        )
    )
