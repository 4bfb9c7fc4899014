"""Event filters: state machines over one symbol's day, as folds, so that symbols and days run in parallel.

A day is one of the zone (New York unless told), whose midnight falls inside sessions of round-the-clock markets at 4 or 5 UTC. Changes are
over the last valid price, so that a missing price is no change.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.windows import by_symbol, filled, lag
from tidemark.operators.registry import event_filter
from tidemark.sources.sinks import ZONE, with_day


def _changes(bars: DataFrame, price: str, zone: str) -> DataFrame:
    """One-bar changes of the last valid price within each symbol and day; the first row of a day has none."""
    day = Window.partitionBy("symbol", "date").orderBy("timestamp")
    rows = with_day(bars, zone=zone).withColumn("__c", F.last(price, ignorenulls=True).over(day.rowsBetween(Window.unboundedPreceding, 0)))
    before = F.lag("__c").over(day)
    return rows.withColumn("__r", F.when(before != 0, F.col("__c") / before - 1)).withColumn("__i", F.row_number().over(day)).where("__i > 1")


def _fold(rows: DataFrame, keys: list[str], fields: list[str], start: Column, step) -> DataFrame:
    """Fold each group's rows by time; step gives the next state with out, an array of emitted rows."""
    grouped = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("timestamp", *fields))).alias("rows"))
    return grouped.select(*keys, F.inline(F.aggregate("rows", start, step, lambda s: s["out"])))


def _emit(state: Column, when: Column, row: Column) -> Column:
    return F.when(when, F.concat(state["out"], F.array(row))).otherwise(state["out"])


def _plus(s: Column, r: Column) -> Column:
    """A sum kept at 0 or above; an unknown change resets it."""
    return F.when(r.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), s + r))


def _minus(s: Column, r: Column) -> Column:
    return F.when(r.isNull(), 0.0).otherwise(F.least(F.lit(0.0), s + r))


@event_filter("cumsum")
def cumsum_events(bars: DataFrame, threshold: float, price: str = "close", zone: str = ZONE) -> DataFrame:
    """Rows where the running sum of changes passes the threshold, up (+1) or down (-1); that sum starts again, the other goes on."""
    kind = "array<struct<timestamp:timestamp_ntz,breakout_side:int>>"
    start = F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("n"), F.array().cast(kind).alias("out"))

    def step(s, x):
        p, n = _plus(s["p"], x["__r"]), _minus(s["n"], x["__r"])
        up, down = p > threshold, (p <= threshold) & (n < -threshold)
        row = F.struct(x["timestamp"].alias("timestamp"), F.when(up, 1).otherwise(-1).alias("breakout_side"))
        return F.struct(F.when(up, 0.0).otherwise(p).alias("p"), F.when(down, 0.0).otherwise(n).alias("n"), _emit(s, up | down, row).alias("out"))

    return _fold(_changes(bars, price, zone), ["symbol", "date"], ["__r"], start, step).select("timestamp", "symbol", "breakout_side")


@event_filter("reversal")
def reversal_events(bars: DataFrame, threshold: float, reversal: float, price: str = "close", zone: str = ZONE) -> DataFrame:
    """Rows where, after a run past the threshold, the sum has turned back from its extreme by over `reversal`."""
    kind = "array<struct<timestamp:timestamp_ntz,breakout_side:int,s_final:double,s_extreme:double>>"
    start = F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("n"), F.lit(0).alias("state"), F.lit(0.0).alias("ext"), F.array().cast(kind).alias("out"))

    def step(s, x):
        p, n, state, ext = _plus(s["p"], x["__r"]), _minus(s["n"], x["__r"]), s["state"], s["ext"]
        begins_up, begins_down = (state == 0) & (p > threshold), (state == 0) & (p <= threshold) & (n < -threshold)
        ends_up, ends_down = (state == 1) & (p <= ext) & (ext - p > reversal), (state == -1) & (n >= ext) & (n - ext > reversal)
        ends = ends_up | ends_down
        row = F.struct(x["timestamp"].alias("timestamp"), state.alias("breakout_side"), F.when(ends_up, p).otherwise(n).alias("s_final"), ext.alias("s_extreme"))
        new_ext = F.when(ends, 0.0).when(begins_up, p).when(begins_down, n).when(state == 1, F.greatest(ext, p)).when(state == -1, F.least(ext, n)).otherwise(0.0)
        new_state = F.when(ends, 0).when(begins_up, 1).when(begins_down, -1).otherwise(state)
        return F.struct(F.when(ends, 0.0).otherwise(p).alias("p"), F.when(ends, 0.0).otherwise(n).alias("n"), new_state.alias("state"), new_ext.alias("ext"), _emit(s, ends, row).alias("out"))

    return _fold(_changes(bars, price, zone), ["symbol", "date"], ["__r"], start, step).select("timestamp", "symbol", "breakout_side", "s_final", "s_extreme")


@event_filter("adaptive")
def adaptive_events(bars: DataFrame, k: float, lookback: int = 60, price: str = "close", zone: str = ZONE) -> DataFrame:
    """As cumsum, by day, with a threshold of k times 100 times the deviation of the last `lookback` changes of the symbol."""
    change = F.coalesce(F.when(lag("__c", 1) != 0, F.col("__c") / lag("__c", 1) - 1), F.lit(0.0))
    frame = by_symbol().rowsBetween(-(lookback - 1), 0)
    rows = with_day(bars, zone=zone).withColumn("__c", filled(price)).withColumn("__r", change).withColumn("__t", F.when(F.count(F.lit(1)).over(frame) == lookback, k * 100 * F.stddev_samp("__r").over(frame))).withColumn("__i", F.row_number().over(by_symbol())).where("__i > 1")
    kind = "array<struct<timestamp:timestamp_ntz>>"
    start = F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("n"), F.array().cast(kind).alias("out"))

    def step(s, x):
        p, n, t = F.greatest(F.lit(0.0), s["p"] + x["__r"]), F.least(F.lit(0.0), s["n"] + x["__r"]), x["__t"]
        up = F.coalesce(p > t, F.lit(False))
        down = ~up & F.coalesce(n < -t, F.lit(False))
        return F.struct(F.when(up, 0.0).otherwise(p).alias("p"), F.when(down, 0.0).otherwise(n).alias("n"), _emit(s, up | down, F.struct(x["timestamp"].alias("timestamp"))).alias("out"))

    return _fold(rows, ["symbol", "date"], ["__r", "__t"], start, step).select("timestamp", "symbol")


def bar_ends(values: np.ndarray, size: float, sum_: float = 0.0) -> tuple[list[int], list[float], float]:
    """Rows at which the running sum from sum_ on reaches `size`, after each of which it starts again; the sums there; and the last sum."""
    at, found, sums, step = 0, [], [], 64
    while at < len(values):
        run = np.cumsum(np.r_[sum_, values[at : at + step]])[1:]
        over = np.flatnonzero(run >= size)
        if len(over):
            found.append(at + int(over[0]))
            sums.append(float(run[over[0]]))
            at, sum_, step = found[-1] + 1, 0.0, max(64, 2 * int(over[0]))
        else:
            at, sum_, step = at + len(run), float(run[-1]), 2 * step
    return found, sums, sum_


def dollar_bars(updates: DataFrame, size: float = 20000.0) -> DataFrame:
    """A bar whenever the traded value since the last reaches `size`. updates: timestamp, symbol, ingestion_timestamp, close, volume (running within the minute).

    A missing price or volume adds nothing. A symbol's updates pass in order through one task, which holds a batch of them and the sum.
    """
    minute = Window.partitionBy("symbol", "timestamp").orderBy("ingestion_timestamp")
    value = F.col("volume") * F.col("close")
    rows = updates.withColumn("__v", value).withColumn("__d", F.coalesce(F.col("__v") - F.coalesce(F.lag("__v").over(minute), F.lit(0.0)), F.lit(0.0)))
    rows = rows.select("symbol", "timestamp", "ingestion_timestamp", "close", "__d").repartition("symbol").sortWithinPartitions("symbol", "timestamp", "ingestion_timestamp", "close", "__d")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sum_ = None, 0.0
        for batch in batches:
            names, values = batch.column("symbol").to_pylist(), batch.column("__d").to_numpy(zero_copy_only=False)
            cuts = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)]
            at, sums = [], []
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                found, made, sum_ = bar_ends(values[a:b], size, sum_ if names[a] == last else 0.0)
                last = names[a]
                at += [a + i for i in found]
                sums += made
            got = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([got.column("ingestion_timestamp"), got.column("symbol"), got.column("close"), pa.array(sums, pa.float64())], ["timestamp", "symbol", "close", "dollar_volume"])

    kinds = dict(updates.dtypes)
    return rows.mapInArrow(run, f"timestamp {kinds['ingestion_timestamp']}, symbol string, close double, dollar_volume double")
