"""Sequences, alignment of features and targets to events, and datasets."""

from __future__ import annotations

import inspect
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.windows import by_symbol
from tidemark.operators.registry import FEATURES
from tidemark.operators.targets import targets

KEY = ["timestamp", "symbol"]


def _arrays(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*KEY, *[F.col(f"__a.{c}").alias(c) for c in columns])


def sequence_rows(features: DataFrame, window: int) -> DataFrame:
    """Each feature column as the array of its last `window` rows, this one included; rows without a full window are left out."""
    columns = [c for c in features.columns if c not in KEY]
    rows = features.withColumn("__a", F.collect_list(F.struct(*columns)).over(by_symbol().rowsBetween(-(window - 1), 0))).where(F.size("__a") == window)
    return _arrays(rows, columns)


def sequence_at_events(events: DataFrame, features: DataFrame, window: int, unit_seconds: int = 60) -> DataFrame:
    """For each event its last `window` feature rows within `window` units of time; an event with fewer is left out."""
    columns = [c for c in features.columns if c not in KEY]
    epoch = F.unix_timestamp(F.col("timestamp").cast("timestamp"))
    frame = Window.partitionBy("symbol").orderBy("__t").rangeBetween(-(window * unit_seconds) + 1, 0)
    rows = features.withColumn("__t", epoch).withColumn("__a", F.collect_list(F.struct("__t", *columns)).over(frame)).where(F.size("__a") >= window)
    rows = rows.withColumn("__a", F.slice("__a", -window, window))
    return _arrays(rows.join(events.select(*KEY).distinct(), KEY, "left_semi"), columns)


def at_events(events: DataFrame, table: DataFrame) -> DataFrame:
    """Event keys with the table's columns, nulls where it has no row."""
    return events.select(*KEY).join(table, KEY, "left")


def wide(bars: DataFrame, features: dict[str, dict], specs: list[tuple[int, float, float]] = (), kind: str = "float") -> DataFrame:
    """Keys, features (label: parameters) and targets of the bars, all over one exchange by symbol. Features whose operators can't carry
    other columns (recursions, another symbol's returns) are joined."""
    out, apart = bars, []
    for label, params in features.items():
        fn = FEATURES[label]
        if "keep" in inspect.signature(fn).parameters:
            out = fn(out, **params, keep=out.columns)
        else:
            apart.append(fn(bars, **params))
    out = targets(out, list(specs), kind, keep=out.columns) if specs else out
    return reduce(lambda a, b: a.join(b, KEY, "left"), apart, out.select(*KEY, *[c for c in out.columns if c not in bars.columns]))


def full_join(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.join(b, KEY, "full"), tables)


def dataset(events: DataFrame, features: list[DataFrame], targets: DataFrame) -> DataFrame:
    """Events with all features and targets, joined to the left on their key. Each side is shuffled by it; `wide` gives one side for all of one table of bars."""
    return reduce(lambda a, b: a.join(b, KEY, "left"), [*features, targets], events.select(*KEY, "breakout_side"))


def select_columns(data: DataFrame, features: list[str], extra: list[str] = ()) -> DataFrame:
    """Key, asked features, all labels, and extra columns; a missing one is an error."""
    if missing := [c for c in [*features, *extra] if c not in data.columns]:
        raise ValueError(f"columns not in the dataset: {missing}")
    labels = [c for c in data.columns if c.startswith("label_")]
    return data.select(*KEY, *dict.fromkeys([*features, *labels, *extra]))
