"""Bars from ticks and updates: aggregation, latest-update selection, regular grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bars_from_ticks(ticks: DataFrame, symbol: Column, ts: Column, price: Column, size: Column, order: Column, unit: str = "hour") -> DataFrame:
    """OHLCV bars. NaN prices become null. Partial aggregates are combined before the one shuffle."""
    price = F.when(F.isnan(price), None).otherwise(price)
    rows = ticks.select(symbol.alias("symbol"), F.date_trunc(unit, ts).cast("timestamp_ntz").alias("timestamp"), price.alias("p"), size.alias("v"), F.struct(ts.alias("t"), order.alias("o")).alias("k"))
    return rows.groupBy("symbol", "timestamp").agg(F.min_by("p", "k").alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", "k").alias("close"), F.sum("v").cast("double").alias("volume"))


def event_bars(events: DataFrame, unit: str = "hour") -> DataFrame:
    size = F.get_json_object("props", "$.k").cast("double")
    return bars_from_ticks(events, F.col("event_type"), F.col("ts"), F.col("value"), size, F.col("event_id"), unit)


def take_latest(updates: DataFrame, keys: list[str], ingested: str, *ties: str) -> DataFrame:
    """For each key the row ingested last, null being first of all; ties by the largest of further columns."""
    return _best(updates, keys, F.max_by, ingested, *ties)


def _best(updates: DataFrame, keys: list[str], fn, *order: str) -> DataFrame:
    """For each key the row of the largest or smallest order, null being the smallest; partial results are combined before the shuffle."""
    rest = [c for c in updates.columns if c not in keys]
    best = updates.groupBy(*keys).agg(fn(F.struct(*rest), F.struct(*order)).alias("__u"))
    return best.select(*[F.col(c) if c in keys else F.col("__u").getField(c).alias(c) for c in updates.columns])


def collect_all_updates(updates: DataFrame, keys: list[str], since: str, until: str, *order: str) -> DataFrame:
    """Updates in [since, until), then the first of each key in the given order."""
    rows = updates.where((F.col("timestamp") >= F.lit(since).cast("timestamp_ntz")) & (F.col("timestamp") < F.lit(until).cast("timestamp_ntz")))
    return _best(rows, keys, F.min_by, *order)


def raw_to_bars(raw: DataFrame) -> DataFrame:
    """The latest update of each (timestamp, symbol) without its ingestion columns."""
    return take_latest(raw, ["timestamp", "symbol"], "ingestion_timestamp", "timestamp_seconds").drop("ingestion_timestamp", "timestamp_seconds")


def orderbook_latest(quotes: DataFrame, unit: str = "minute") -> DataFrame:
    """The latest quote of each symbol and minute; quotes never ingested are left out."""
    rows = quotes.where("ingestion_timestamp is not null").withColumn("timestamp", F.date_trunc(unit, "timestamp").cast("timestamp_ntz"))
    return take_latest(rows, ["timestamp", "symbol"], "ingestion_timestamp", "quote_id")


def orderbook_updates(quotes: DataFrame, since: str, until: str, unit: str = "minute") -> DataFrame:
    """All-updates mode: of the quotes in [since, until) the first of each symbol and minute by ingestion, one never ingested being first."""
    rows = quotes.withColumn("timestamp", F.date_trunc(unit, "timestamp").cast("timestamp_ntz"))
    return collect_all_updates(rows, ["timestamp", "symbol"], since, until, "ingestion_timestamp", "quote_id")


def upsample(bars: DataFrame, interval: str, columns: list[str]) -> DataFrame:
    """A regular grid from each symbol's first to last bar, filled forward; rows off the grid are left out."""
    ends = bars.groupBy("symbol").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    grid = ends.select("symbol", F.explode(F.expr(f"sequence(a, b, interval {interval})")).alias("timestamp"))
    order = Window.partitionBy("symbol").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    joined = grid.join(bars.select("symbol", "timestamp", *columns), ["symbol", "timestamp"], "left")
    return joined.select("symbol", "timestamp", *[F.last(c, ignorenulls=True).over(order).alias(c) for c in columns])


def in_range(df: DataFrame, since, until, column: str = "timestamp") -> DataFrame:
    """The half-open range [since, until); it reaches the scan as a pushed filter."""
    return df.where((F.col(column) >= F.lit(since)) & (F.col(column) < F.lit(until)))


def tolerant_select(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of the columns that exist."""
    return df.select(*[c for c in columns if c in df.columns])
