"""python -m tidemark LAYER ACTION: list, check or cache raw bars, features, targets, events, both at events, and datasets over a table of bars by day."""

from __future__ import annotations

import argparse
from datetime import date, timedelta

from tidemark.operators import events as _events  # noqa: F401 (registers the filters)
from tidemark.operators import registry
from tidemark.plans import layers
from tidemark.sources import raw


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("layer", choices=["raw", "feature", "target", "events", "resampled", "dataset"])
    p.add_argument("action", choices=["list", "check", "cache"])
    p.add_argument("--source", help="raw: parquet of updates with ingestion_timestamp and timestamp_seconds")
    p.add_argument("--raw", help="bars by day")
    p.add_argument("--root", help="where layers are kept")
    p.add_argument("--since"), p.add_argument("--until")
    p.add_argument("--label", default="all", help="feature or event filter")
    p.add_argument("--params", default="", help="name:value,name:[a,b]")
    p.add_argument("--events", default="", help="resampled: filter@name:value")
    p.add_argument("--targets", default="5:0.03:0.03", help="period:tp:sl, comma-joined, or fp:5,10|tp:0.03|sl:0.03")
    p.add_argument("--manifest", help="file with a dataset's manifest")
    p.add_argument("--security", default="all", help="all, crypto, forex or stock")
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--bars-per-day", type=int, default=390)
    return p


def main(argv: list[str] | None = None, spark=None) -> list[str]:
    """Runs one command and returns the lines it printed."""
    a = parser().parse_args(argv)
    said: list[str] = []

    def say(line) -> None:
        said.append(str(line))
        print(line)

    params = {k: tuple(v) if isinstance(v, list) else v for k, v in registry.from_text(a.params).items()}
    labels = registry.list_features(a.security) if a.label == "all" else [a.label]
    if a.action == "list" and a.layer not in ("dataset", "raw"):
        for x in {"feature": labels, "resampled": labels, "events": list(registry.FILTERS), "target": ["forward_return", "tp_sl_long", "tp_sl_short"]}[a.layer]:
            say(x)
        return said
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.getOrCreate()
    if a.action == "list" and a.layer == "raw":
        for day in raw.days_of(spark, a.raw):
            say(day)
        return said
    if a.action == "list":
        for name, m in sorted(layers.manifests(spark, a.root).items()):
            say(f"{name} {','.join(sorted(m['features']))}")
        return said
    if a.layer == "raw":
        if a.action == "check":
            have = set(raw.days_of(spark, a.raw))
            for day, _ in raw.split_days(date.fromisoformat(a.since), date.fromisoformat(a.until)):
                if day not in have:
                    say(f"raw {day}")
        else:
            source = lambda x, y: raw.fetch(spark.read.parquet(a.source), "candle", "take_latest", date.fromisoformat(x) - timedelta(days=1), date.fromisoformat(y) + timedelta(days=1))
            for day in raw.fill(spark, source, a.raw, a.since, a.until, a.overwrite):
                say(f"raw {day}")
        return said
    specs = registry.target_specs(a.targets) if a.targets.startswith(("fp:", "tp:", "sl:")) else [(int(x), float(y), float(z)) for x, y, z in (t.split(":") for t in a.targets.split(","))]
    at, _, at_params = a.events.partition("@")
    at_events = (at, registry.event_params(at, at_params)) if at else None
    if a.action == "check":
        paths = {"feature": [f"features/{layers.key_of(x, params)}" for x in labels], "events": [f"events/{layers.key_of(a.label, params)}"], "resampled": [layers.resampled_path("", "features", at_events, x, params).lstrip("/") for x in labels] if at_events else [], "target": [f"targets/{layers.key_of('targets', {'specs': [list(s) for s in specs]})}"]}
        if a.layer == "dataset":
            with open(a.manifest) as f:
                paths["dataset"] = [f"datasets/{layers.dataset_key(layers.parse_manifest(f.read()))}/data"]
        for path in paths[a.layer]:
            for day in layers.missing(spark, a.raw, f"{a.root}/{path}", a.since, a.until):
                say(f"{path} {day}")
        return said
    common = (a.since, a.until, a.overwrite)
    if a.layer == "feature":
        for x in labels:
            say(layers.cache_feature(spark, a.raw, a.root, x, params, *common, a.bars_per_day))
    elif a.layer == "events":
        say(layers.cache_events(spark, a.raw, a.root, a.label, params, *common))
    elif a.layer == "resampled":
        for x in labels:
            say(layers.cache_feature_at_events(spark, a.raw, a.root, at_events, x, params, *common))
        say(layers.cache_targets_at_events(spark, a.raw, a.root, at_events, specs, *common))
    elif a.layer == "target":
        say(layers.cache_targets(spark, a.raw, a.root, specs, *common, a.bars_per_day))
    else:
        with open(a.manifest) as f:
            spec = layers.parse_manifest(f.read())
        say(layers.cache_dataset(spark, a.raw, a.root, spec, *common, a.bars_per_day))
        found = raw.summary(layers.load_dataset(spark, a.root, spec, a.since, a.until)).first()
        say(f"{found.n_rows} rows, {found.n_columns} columns, {found.n_symbols} symbols, {found.first_time} to {found.last_time}")
    return said


if __name__ == "__main__":
    main()
