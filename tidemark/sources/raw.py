"""The raw layer: requests for time ranges, queries of a source, and a read-through cache of bars by day. Any path that Spark reads is a store."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import bars as B
from tidemark.sources import sinks

KEY = ["timestamp", "symbol"]


def time_range(since: datetime | date | str | int | float, until: datetime | date | str | int | float) -> tuple[datetime, datetime]:
    """Both ends in UTC without a zone, from times (without a zone: UTC), dates or ISO text, or epoch seconds. An empty or mixed range is an error."""

    def one(x) -> datetime:
        if isinstance(x, bool) or x is None:
            raise ValueError(f"not a time: {x!r}")
        if isinstance(x, (int, float)):
            return datetime.fromtimestamp(x, timezone.utc).replace(tzinfo=None)
        if isinstance(x, str):
            x = datetime.fromisoformat(x)
        elif not isinstance(x, datetime):
            x = datetime(x.year, x.month, x.day)
        return x.astimezone(timezone.utc).replace(tzinfo=None) if x.tzinfo else x

    numbers = [isinstance(x, (int, float)) for x in (since, until)]
    if numbers[0] != numbers[1]:
        raise ValueError("both ends are epoch seconds, or neither")
    a, b = one(since), one(until)
    if a >= b:
        raise ValueError(f"{a} isn't before {b}")
    return a, b


def iso_text(t: datetime) -> str:
    """A UTC time as text with its offset."""
    return t.replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%S%z")


def split_days(since: date, until: date, step: int = 1, warmup: int = 0) -> list[tuple[date, date]]:
    """[since, until) in parts of `step` days, each begun `warmup` days early; the last ends with the range."""
    days = range(0, (until - since).days, step)
    return [(since + timedelta(days=i - warmup), min(until, since + timedelta(days=i + step))) for i in days]


def query(spark: SparkSession, sql: str, ts: str = "timestamp", zone: str = sinks.ZONE) -> DataFrame:
    """Rows of a query, one of each (time, symbol), with `date`, the day of the zone. No rows give an empty table of the same columns."""
    rows = spark.sql(sql).withColumnRenamed(ts, "timestamp")
    return sinks.with_day(rows.dropDuplicates(KEY), zone=zone)


#: What a source can be asked for: kind and mode to a function of (rows, since, until) that gives one row of each (timestamp, symbol).
MODES: dict[tuple[str, str], Callable[[DataFrame, datetime, datetime], DataFrame]] = {
    ("candle", "take_latest"): lambda rows, a, b: B.raw_to_bars(B.in_range(rows, a, b)),
    ("candle", "collect_all_updates"): lambda rows, a, b: B.collect_all_updates(rows, KEY, str(a), str(b), "ingestion_timestamp", "timestamp_seconds"),
    ("orderbook1l", "take_latest"): lambda rows, a, b: B.orderbook_latest(B.in_range(rows, a, b)),
    ("orderbook1l", "collect_all_updates"): lambda rows, a, b: B.orderbook_updates(rows, str(a), str(b)),
}


def fetch(rows: DataFrame, kind: str, mode: str, since, until) -> DataFrame:
    """Rows of a source by kind (candle, orderbook1l) and mode (take_latest, collect_all_updates) in [since, until)."""
    if (kind, mode) not in MODES:
        raise ValueError(f"no {mode!r} of {kind!r}; there are {sorted(MODES)}")
    return MODES[kind, mode](rows, *time_range(since, until))


def days_of(spark: SparkSession, path: str) -> list[date]:
    """Dates at path, from the names of its partitions."""
    if not sinks.exists(spark, path):
        return []
    at, fs = sinks.at(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(date.fromisoformat(n[5:]) for n in names if n.startswith("date=") and n[5:7].isdigit())


def fill(spark: SparkSession, source: Callable[[str, str], DataFrame], path: str, since: str, until: str, overwrite: bool = False) -> list[date]:
    """Ask the source for the days of [since, until) that path lacks (all days with overwrite), one request for each run of days, and store
    what it has. source(a, b) gives bars of the New York days in [a, b). Returns the days asked for; a day without rows is asked for again."""
    wanted = [a for a, _ in split_days(date.fromisoformat(since), date.fromisoformat(until))]
    have = set() if overwrite else set(days_of(spark, path))
    todo = [d for d in wanted if d not in have]
    runs: list[list[date]] = []
    for d in todo:
        if runs and (d - runs[-1][-1]).days == 1:
            runs[-1].append(d)
        else:
            runs.append([d])
    for run in runs:
        rows = source(run[0].isoformat(), (run[-1] + timedelta(days=1)).isoformat())
        rows = sinks.with_day(rows).where((F.col("date") >= F.lit(run[0])) & (F.col("date") <= F.lit(run[-1]))).drop("date")
        sinks.write_days(rows, path)
    return todo


def read_through(spark: SparkSession, source: Callable[[str, str], DataFrame], path: str, since: str, until: str, columns: list[str] | None = None, interval: str | None = None) -> DataFrame:
    """Bars of [since, until): days at path are read, others asked from the source and stored first. columns: those of them that exist.
    interval: a regular grid, filled forward."""
    fill(spark, source, path, since, until)
    if not sinks.exists(spark, path):
        return source(since, until).limit(0)
    rows = sinks.read_days(spark, path, since, until, columns)
    if interval:
        rows = B.upsample(rows, interval, [c for c in rows.columns if c not in (*KEY, "date")])
    return rows


def summary(df: DataFrame) -> DataFrame:
    """One row: n_rows, n_columns, n_symbols, first and last time of a table with timestamp and symbol."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"), F.count_distinct("symbol").alias("n_symbols"), F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"))
