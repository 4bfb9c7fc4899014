"""Materialised layers by day: features, targets, events and datasets, of which only missing days are computed.

Layout: {root}/{layer}/{key}/date=..., key being the label and a digest of the parameters; a dataset also has a manifest.
"""

from __future__ import annotations

import inspect
import json
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.windows import ffd_weights
from tidemark.operators import align, events, registry
from tidemark.operators import features as _features  # noqa: F401 (registers the features)
from tidemark.operators.targets import targets
from tidemark.sources import sinks
from tidemark.sources.raw import days_of

#: Features whose value depends on all earlier bars (garch on all bars), so that they read the whole history.
RECURSIVE = {"ema", "garch", "bollinger", "volume"}


def warmup_bars(label: str, params: dict) -> int:
    """A bound of the bars before a row that its value depends on, for features with bounded frames: frames of all parameters, defaults included, in a chain."""
    fn = registry.FEATURES[label]
    given = {k: v.default for k, v in inspect.signature(fn).parameters.items() if v.default is not v.empty} | params
    spans = [max([x for x in (v if isinstance(v, (list, tuple)) else [v]) if isinstance(x, int) and not isinstance(x, bool)], default=0) for v in given.values()]
    need = sum(spans) + 1 if any(spans) else 0
    if label.startswith("ffd"):
        need += len(ffd_weights(given.get("d", 0.4), given.get("threshold", 1e-3)))
    return 2 * need if label == "market_regime" else need  # volatility over a frame of volatilities


def key_of(label: str, params: dict) -> str:
    return f"{label}-{registry.dataset_id(params)}"


def _calendar(since: str, until: str) -> list[date]:
    a, b = date.fromisoformat(since), date.fromisoformat(until)
    return [a + timedelta(days=i) for i in range((b - a).days)]


def _bars(spark: SparkSession, raw: str, first: date | None, last: date) -> DataFrame:
    rows = spark.read.parquet(raw).where(F.col("date") <= F.lit(last))
    return (rows.where(F.col("date") >= F.lit(first)) if first else rows).drop("date")


def _reach(spark: SparkSession, raw: str, edge: date, bars: int, ahead: bool) -> date | None:
    """The day before edge (ahead: after it) that each symbol must be read to for `bars` bars of its own, or for all it has; None if there is no such day."""
    out = F.col("date") > F.lit(edge) if ahead else F.col("date") < F.lit(edge)
    nearest = Window.partitionBy("symbol").orderBy(F.col("date").asc() if ahead else F.col("date").desc())
    days = spark.read.parquet(raw).where(out).groupBy("symbol", "date").count().withColumn("so_far", F.sum("count").over(nearest.rowsBetween(Window.unboundedPreceding, 0)))
    enough = F.when(F.col("so_far") >= bars, F.col("date"))
    near, far = (F.min, F.max) if ahead else (F.max, F.min)
    return days.groupBy("symbol").agg(F.coalesce(near(enough), far("date")).alias("day")).agg(far("day")).first()[0]


def _write(df: DataFrame, path: str, days: list[date]) -> None:
    sinks.write_days(sinks.with_day(df).where((F.col("date") >= F.lit(days[0])) & (F.col("date") <= F.lit(days[-1])) & F.col("date").isin(days)).drop("date"), path)


def missing(spark: SparkSession, raw: str, path: str, since: str, until: str) -> list[date]:
    """Days of [since, until) that raw has and path lacks."""
    have, wanted = set(days_of(spark, path)), set(_calendar(since, until))
    return [d for d in days_of(spark, raw) if d in wanted and d not in have]


def cache_feature(spark: SparkSession, raw: str, root: str, label: str, params: dict, since: str, until: str, overwrite: bool = False, bars_per_day: int = 390, sequence: int = 0) -> str:
    """Compute a feature's missing days (all days with overwrite) and return its path.

    Bars before the first such day are read as far as the feature's frames reach: until each symbol has that many bars
    by count, or all it has; recursive features read all. `bars_per_day` has no effect. With `sequence`, the last so many rows as arrays.
    """
    path = f"{root}/features/{key_of(label, params | ({'sequence': sequence} if sequence else {}))}"
    todo = [d for d in days_of(spark, raw) if d in set(_calendar(since, until))] if overwrite else missing(spark, raw, path, since, until)
    if todo:
        need = warmup_bars(label, params) + sequence
        first = None if label in RECURSIVE else (need and _reach(spark, raw, todo[0], need, False)) or todo[0]
        out = registry.FEATURES[label](_bars(spark, raw, first, todo[-1] if label != "garch" else date.max), **params)
        _write(align.sequence_rows(out, sequence) if sequence else out, path, todo)
    return path


def cache_targets(spark: SparkSession, raw: str, root: str, specs: list[tuple[int, float, float]], since: str, until: str, overwrite: bool = False, bars_per_day: int = 390) -> str:
    """Targets of missing days; they look ahead, so later days are read until each symbol has the longest period's bars. `bars_per_day` has no effect."""
    path = f"{root}/targets/{key_of('targets', {'specs': [list(s) for s in specs]})}"
    todo = [d for d in days_of(spark, raw) if d in set(_calendar(since, until))] if overwrite else missing(spark, raw, path, since, until)
    if todo:
        last = _reach(spark, raw, todo[-1], max(p for p, _, _ in specs) + 1, True) or todo[-1]
        _write(targets(_bars(spark, raw, todo[0], last), specs), path, todo)
    return path


def cache_events(spark: SparkSession, raw: str, root: str, label: str, params: dict, since: str, until: str, overwrite: bool = False) -> str:
    """Events of missing days. Filters start each New York day anew, and days are stored by it, so no other day is read; the adaptive threshold reads back."""
    path = f"{root}/events/{key_of(label, params)}"
    todo = [d for d in days_of(spark, raw) if d in set(_calendar(since, until))] if overwrite else missing(spark, raw, path, since, until)
    if todo:
        first = None if label == "adaptive" else todo[0]
        _write(registry.FILTERS[label](_bars(spark, raw, first, todo[-1]), **params), path, todo)
    return path


def resampled_path(root: str, layer: str, events: tuple[str, dict], label: str, params: dict) -> str:
    """Of a feature or of targets at events: layer is features or targets."""
    return f"{root}/{layer}_at_events/{key_of(*events)}/{key_of(label, params)}"


def cache_feature_at_events(spark: SparkSession, raw: str, root: str, events: tuple[str, dict], label: str, params: dict, since: str, until: str, overwrite: bool = False, sequence: int = 0) -> str:
    """A feature at the events' keys, by day; events and the feature are filled first. With `sequence`, its last so many rows as arrays."""
    path = resampled_path(root, "features", events, label, params | ({"sequence": sequence} if sequence else {}))
    return _cache_at_events(spark, raw, root, events, path, lambda a, b: cache_feature(spark, raw, root, label, params, a, b, overwrite, sequence=sequence), since, until, overwrite)


def cache_targets_at_events(spark: SparkSession, raw: str, root: str, events: tuple[str, dict], specs: list[tuple[int, float, float]], since: str, until: str, overwrite: bool = False) -> str:
    """Targets at the events' keys, by day; events and targets are filled first."""
    path = resampled_path(root, "targets", events, "targets", {"specs": [list(s) for s in specs]})
    return _cache_at_events(spark, raw, root, events, path, lambda a, b: cache_targets(spark, raw, root, specs, a, b, overwrite), since, until, overwrite)


def _cache_at_events(spark: SparkSession, raw: str, root: str, events: tuple[str, dict], path: str, side, since: str, until: str, overwrite: bool) -> str:
    todo = [d for d in days_of(spark, raw) if d in set(_calendar(since, until))] if overwrite else missing(spark, raw, path, since, until)
    if todo:
        a, b = todo[0].isoformat(), (todo[-1] + timedelta(days=1)).isoformat()
        read = lambda p: sinks.read_days(spark, p, a, b).drop("date")
        _write(align.at_events(read(cache_events(spark, raw, root, *events, a, b, overwrite)), read(side(a, b))), path, todo)
    return path


# ---------------------------------------------------------------- datasets


def manifest_text(spec: dict) -> str:
    """A dataset's parameters as text: sections for events, targets, sequence, kept columns and features, and when it was made."""
    label, params = spec["events"]
    lines = ["Dataset", "=======", "", "Resample:", f"{label}: {registry.to_text(params)}", "", "Target:", *[registry.to_text({"period": p, "tp": t, "sl": s}) for p, t, s in spec["targets"]], ""]
    if spec.get("sequence"):
        lines += ["Sequential:", f"window:{spec['sequence']}", ""]
    if spec.get("columns"):
        lines += ["Resample Columns:", ",".join(spec["columns"]), ""]
    lines += ["Feature:", *[f"{k}: {registry.to_text(v)}" for k, v in sorted(spec["features"].items())], "", f"Generated: {datetime.now(timezone.utc).isoformat()}"]
    return "\n".join(lines)


def parse_manifest(text: str) -> dict:
    """The inverse of manifest_text; an unknown section or a missing one is an error."""
    spec: dict = {"events": None, "targets": [], "sequence": 0, "columns": [], "features": {}}
    heads = {"Resample:": "events", "Target:": "targets", "Sequential:": "sequence", "Resample Columns:": "columns", "Feature:": "features"}
    section = None
    for line in filter(None, map(str.strip, text.splitlines()[2:])):
        if line.startswith("Generated:"):
            break
        if line in heads:
            section = heads[line]
        elif section in ("events", "features"):
            label, _, params = line.partition(":")
            got = {k: tuple(v) if isinstance(v, list) else v for k, v in registry.from_text(params.strip()).items()}
            if section == "events":
                spec["events"] = (label, got)
            else:
                spec["features"][label] = got
        elif section == "targets":
            t = registry.from_text(line)
            spec["targets"].append((t["period"], t["tp"], t["sl"]))
        elif section == "sequence":
            spec["sequence"] = registry.from_text(line)["window"]
        elif section == "columns":
            spec["columns"] = line.split(",")
        else:
            raise ValueError(f"line outside a section: {line!r}")
    if spec["events"] is None:
        raise ValueError("no Resample section")
    return spec


def dataset_key(spec: dict) -> str:
    label, params = spec["events"]
    return registry.dataset_id({"events": [label, params], "targets": spec["targets"], "sequence": spec.get("sequence", 0), "columns": spec.get("columns", []), "features": spec["features"]})


def cache_dataset(spark: SparkSession, raw: str, root: str, spec: dict, since: str, until: str, overwrite: bool = False, bars_per_day: int = 390) -> str:
    """Events with aligned features and targets, by day, with a manifest. All layers it needs are filled first.

    spec: events (label, params), targets [(period, tp, sl)], features {label: params}, sequence (0: none), columns (event columns kept).
    """
    label, params = spec["events"]
    path = f"{root}/datasets/{dataset_key(spec)}"
    todo = [d for d in days_of(spark, raw) if d in set(_calendar(since, until))] if overwrite else missing(spark, raw, f"{path}/data", since, until)
    if not todo:
        return path
    a, b = todo[0].isoformat(), (todo[-1] + timedelta(days=1)).isoformat()
    read = lambda p: sinks.read_days(spark, p, a, b).drop("date")
    at = read(cache_events(spark, raw, root, label, params, a, b, overwrite))
    if label == "adaptive":
        at = at.withColumn("breakout_side", F.lit(None).cast("int"))
    n = spec.get("sequence", 0)
    sides = [read(cache_feature(spark, raw, root, k, v, a, b, overwrite, bars_per_day, n)) for k, v in sorted(spec["features"].items())]
    labels = read(cache_targets(spark, raw, root, spec["targets"], a, b, overwrite, bars_per_day))
    out = align.dataset(at, sides, labels)
    if kept := [c for c in spec.get("columns", []) if c not in out.columns]:
        out = out.join(_bars(spark, raw, todo[0], todo[-1]).select(*align.KEY, *kept), align.KEY, "left")
    _write(out, f"{path}/data", todo)
    sinks.put_text(spark, f"{path}/manifest.txt", manifest_text(spec))
    return path


def manifests(spark: SparkSession, root: str) -> dict[str, dict]:
    """Parsed manifests of the datasets under root, by name."""
    base = f"{root}/datasets"
    if not sinks.exists(spark, base):
        return {}
    rows = spark.read.text(f"{base}/*/manifest.txt", wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -2).alias("name"), "value").collect()  # one small text for each dataset
    return {r["name"]: parse_manifest(r["value"]) for r in rows}


def load_dataset(spark: SparkSession, root: str, spec: dict, since: str, until: str, columns: list[str] | None = None) -> DataFrame:
    """Rows of a dataset with the spec's events, targets and sequence and at least its features: the smallest such, then the first by name.

    With columns, the key, those columns, all labels and the kept event columns; a missing one is an error.
    """
    frozen = lambda x: json.dumps(x, sort_keys=True, default=list)
    known = {name: {"features": [f"{k}@{frozen(v)}" for k, v in m["features"].items()], "rest": frozen([m["events"], m["targets"], m["sequence"]])} for name, m in manifests(spark, root).items()}
    name = registry.smallest_superset(known, [f"{k}@{frozen(v)}" for k, v in spec["features"].items()], rest=frozen([spec["events"], spec["targets"], spec.get("sequence", 0)]))
    if name is None:
        raise LookupError("no dataset holds these features with these parameters")
    rows = sinks.read_days(spark, f"{root}/datasets/{name}/data", since, until).drop("date")
    return align.select_columns(rows, columns, spec.get("columns", [])) if columns is not None else rows
