"""Event filters over a stream of bars: each symbol's day keeps its sums, and bars wait until the watermark has passed them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.sources.sinks import ZONE

#: state of one (symbol, date): whether a bar was met, the last price, the two sums, the run's state and extreme, and the bars that wait
STATE = "begun boolean, last double, p double, n double, run int, ext double, at array<long>, price array<double>"


def _cumsum(threshold: float) -> Callable:
    """(p, n, run, ext, change) to the next four and the event, or None."""

    def step(p, n, run, ext, r):
        p, n = (0.0, 0.0) if r is None else (max(0.0, p + r), min(0.0, n + r))
        if p > threshold:
            return 0.0, n, run, ext, (1, None, None)
        if n < -threshold:
            return p, 0.0, run, ext, (-1, None, None)
        return p, n, run, ext, None

    return step


def _reversal(threshold: float, reversal: float) -> Callable:
    def step(p, n, run, ext, r):
        p, n = (0.0, 0.0) if r is None else (max(0.0, p + r), min(0.0, n + r))
        now = p if run == 1 else n
        if run and (ext - now) * run > reversal:
            return 0.0, 0.0, 0, 0.0, (run, now, ext)
        if run:
            return p, n, run, max(ext, p) if run == 1 else min(ext, n), None
        if p > threshold:
            return p, n, 1, p, None
        if n < -threshold:
            return p, n, -1, n, None
        return p, n, 0, 0.0, None

    return step


def _filtered(bars: DataFrame, step: Callable, late: str, price: str, zone: str) -> DataFrame:
    rows = bars.select("symbol", F.col("timestamp").cast("timestamp").alias("timestamp"), F.col(price).cast("double").alias("price"))
    rows = rows.withWatermark("timestamp", late).withColumn("date", F.to_date(F.from_utc_timestamp("timestamp", zone)))

    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        begun, last, p, n, at_run, ext, at, prices = state.get if state.exists else (False, None, 0.0, 0.0, 0, 0.0, [], [])
        waiting = list(zip(at, prices, strict=True))
        for f in frames:
            stamps = pd.to_datetime(f["timestamp"]).astype("datetime64[us]").astype("int64")
            waiting += [(int(t), None if pd.isna(x) else float(x)) for t, x in zip(stamps, f["price"], strict=True)]
        waiting.sort(key=lambda w: w[0])
        mark = state.getCurrentWatermarkMs()
        out, done = [], 0
        for t, x in waiting:
            if t // 1000 > mark:
                break
            done += 1
            if begun:  # the day's first bar has no change
                r = (last if x is None else x) / last - 1 if last not in (None, 0.0) else None
                p, n, at_run, ext, event = step(p, n, at_run, ext, r)
                if event:
                    out.append((datetime.fromtimestamp(t / 1e6, timezone.utc).replace(tzinfo=None), key[0], *event))
            begun, last = True, last if x is None else x
        waiting = waiting[done:]
        end = int(datetime.combine(key[1] + timedelta(days=1), time(), ZoneInfo(zone)).timestamp() * 1000)
        if not waiting and mark >= end:
            state.remove()
        else:
            state.update((begun, last, p, n, at_run, ext, [t for t, _ in waiting], [x for _, x in waiting]))
            state.setTimeoutTimestamp(max(mark + 1, waiting[0][0] // 1000 if waiting else end))
        yield pd.DataFrame(out, columns=["timestamp", "symbol", "breakout_side", "s_final", "s_extreme"])

    schema = "timestamp timestamp, symbol string, breakout_side int, s_final double, s_extreme double"
    found = rows.groupBy("symbol", "date").applyInPandasWithState(run, schema, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return found.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def stream_cumsum_events(bars: DataFrame, threshold: float, late: str = "5 minutes", price: str = "close", zone: str = ZONE) -> DataFrame:
    """The events of cumsum_events, each sent when the watermark passes its bar, whatever the order of arrival."""
    return _filtered(bars, _cumsum(threshold), late, price, zone).drop("s_final", "s_extreme")


def stream_reversal_events(bars: DataFrame, threshold: float, reversal: float, late: str = "5 minutes", price: str = "close", zone: str = ZONE) -> DataFrame:
    """The events of reversal_events, sent likewise."""
    return _filtered(bars, _reversal(threshold, reversal), late, price, zone)
