"""Registries of features and event filters, parameter strings, and the planner that finds the features of columns."""

from __future__ import annotations

import hashlib
import inspect
import json
import re
from collections.abc import Callable
from itertools import combinations

FEATURES: dict[str, Callable] = {}
LISTED: list[str] = []
FILTERS: dict[str, Callable] = {}


def feature(label: str, listed: bool = True):
    def add(fn):
        FEATURES[label] = fn
        if listed:
            LISTED.append(label)
        return fn

    return add


def event_filter(label: str):
    def add(fn):
        FILTERS[label] = fn
        return fn

    return add


def list_features(security: str) -> list[str]:
    """Listed features fit for a kind of security."""
    # Prefixes each kind leaves out
    left_out = {"all": (), "forex": ("usd_", "btc_"), "crypto": ("usd_",), "stock": ("btc_",)}
    if security not in left_out:
        raise ValueError(f"unknown security type {security!r}")
    return [x for x in LISTED if not x.startswith(left_out[security])]


def features_of(columns: list[str]) -> dict[str, dict]:
    """The features, with parameters, that give the columns: column pruning by feature. Unknown columns are an error."""
    rules = [
        (r"return_(\d+)", "returns", "periods"), (r"ema_(?:rel_)?(\d+)", "ema", "periods"), (r"bb_(?:middle|upper|lower|position|width)", "bollinger", None), (r"volatility_(\d+)", "volatility", "windows"),
        (r"rsi|open_close_ratio|autocorr_lag1|hl_range_pct|close_zscore|close_minmax", "indicators", None), (r"obv_ffd_zscore|obv_pct_change_log|volume_ratio_log", "volume", None), (r"garch_volatility", "garch", None),
        (r"hour_of_day|time_of_day_bin", "time_of_day", None), (r"btc_return_(\d+)", "btc_features", "periods"), (r"ffd_zscore_(\w+)", "ffd_zscore", "columns"), (r"ffd_volatility_zscore_\w+", "ffd_volatility_zscore", None),
        (r"volatility_(?:regime|zscore)_(\d+)", "market_regime", "windows"), (r"return_(?:mean|variance|volatility|skewness|excess_kurtosis)", "market_regime", None),
    ]
    found: dict[str, dict] = {}
    for c in columns:
        hit = next(((label, name, m) for pattern, label, name in rules if (m := re.fullmatch(pattern, c))), None)
        if hit is None:
            raise ValueError(f"no feature gives column {c!r}")
        label, name, m = hit
        params = found.setdefault(label, {})
        if name:
            params[name] = tuple(sorted({*params.get(name, ()), int(m[1]) if m[1].isdigit() else m[1]}, key=str if name == "columns" else int))
    return found


def to_text(params: dict) -> str:
    """k:v, comma-joined; lists in brackets."""
    one = lambda v: "[" + ",".join(map(one, v)) + "]" if isinstance(v, (list, tuple)) else str(v)
    return ",".join(f"{k}:{one(v)}" for k, v in params.items())


def from_text(text: str) -> dict:
    """The inverse of to_text for numbers, booleans, words and flat lists; anything else is an error."""

    def value(v: str):
        if v.startswith("["):
            if not v.endswith("]"):
                raise ValueError(f"unclosed list in {text!r}")
            return [value(x) for x in v[1:-1].split(",") if x]
        for kind in (int, float):
            try:
                return kind(v)
            except ValueError:
                pass
        return {"True": True, "False": False, "None": None}.get(v, v)

    out = {}
    for part in re.split(r",(?![^\[]*\])", text) if text else []:
        name, found, v = part.partition(":")
        if not found or not name:
            raise ValueError(f"expected name:value, got {part!r}")
        out[name] = value(v)
    return out


# Parameters of the event filters that each kind of security is usually given; stock and crypto have the same
_WIDE = {"cumsum": [{"threshold": t} for t in (0.03, 0.05, 0.07, 0.1, 0.15)], "reversal": [{"threshold": t, "reversal": r} for t, r in ((0.07, 0.02), (0.1, 0.02), (0.15, 0.03))]}
EVENT_DEFAULTS = {
    "stock": _WIDE,
    "crypto": _WIDE,
    "forex": {"cumsum": [{"threshold": t} for t in (0.0025, 0.005, 0.01)], "reversal": [{"threshold": 0.0025, "reversal": 0.005}]},
    "default": {"cumsum": _WIDE["cumsum"], "reversal": [{"threshold": 0.1, "reversal": 0.02}]},
}
# Periods and levels of the usual targets
TARGET_PERIODS, TARGET_LEVELS = (5, 10, 30), (0.015, 0.03, 0.05)


def event_defaults(label: str, security: str = "default") -> list[dict]:
    """The usual parameter sets of a filter for a kind of security."""
    if security not in EVENT_DEFAULTS:
        raise ValueError(f"unknown security type {security!r}")
    if label not in EVENT_DEFAULTS[security]:
        raise ValueError(f"{label!r} has no usual parameters")
    return EVENT_DEFAULTS[security][label]


def event_params(label: str, text: str) -> dict:
    """Parameters of a filter from text: all that have no default, none that it doesn't know, numbers above 0."""
    known = dict(list(inspect.signature(FILTERS[label]).parameters.items())[1:])
    found = from_text(text)
    if wrong := set(found) - set(known):
        raise ValueError(f"{label} has no parameters {sorted(wrong)}")
    if lacking := {k for k, v in known.items() if v.default is v.empty} - set(found):
        raise ValueError(f"{label} needs {sorted(lacking)}")
    if bad := {k: v for k, v in found.items() if k not in ("price", "zone") and (isinstance(v, (bool, str)) or v is None or not v > 0)}:
        raise ValueError(f"not above 0: {bad}")
    return found


def target_specs(text: str = "") -> list[tuple[int, float, float]]:
    """(period, take profit, stop loss): every combination of fp:5,10|tp:0.03|sl:0.03. Without text, the usual periods and levels, each level on both sides."""
    if not text:
        return [(p, x, x) for p in TARGET_PERIODS for x in TARGET_LEVELS]
    parts = dict(part.split(":", 1) for part in text.split("|"))
    if wrong := set(parts) - {"fp", "tp", "sl"}:
        raise ValueError(f"unknown parts {sorted(wrong)}")
    listed = lambda k, kind, default: [kind(x) for x in parts[k].split(",")] if k in parts else list(default)
    specs = [(p, t, s) for p in listed("fp", int, TARGET_PERIODS) for t in listed("tp", float, TARGET_LEVELS) for s in listed("sl", float, TARGET_LEVELS)]
    if any(p < 1 or t <= 0 or s <= 0 for p, t, s in specs):
        raise ValueError(f"periods are from 1 on and levels above 0: {text!r}")
    return specs


def specs_to_text(specs: list[tuple[int, float, float]]) -> str:
    """The inverse of target_specs where specs are a full product; others are an error, for the text couldn't tell them apart."""
    sides = [list(dict.fromkeys(x)) for x in zip(*specs, strict=True)]
    if sorted(specs) != sorted((p, t, s) for p in sides[0] for t in sides[1] for s in sides[2]):
        raise ValueError("not every combination is there")
    return "|".join(f"{k}:{','.join(map(str, v))}" for k, v in zip(("fp", "tp", "sl"), sides, strict=True))


def columns_of(label: str, params: dict, bars) -> list[str]:
    """The columns that a feature gives for some bars, from its plan alone."""
    return [c for c in FEATURES[label](bars, **params).columns if c not in ("timestamp", "symbol")]


def dataset_id(params: dict) -> str:
    """The first 12 hex digits of the SHA-256 of the parameters' canonical JSON."""
    return hashlib.sha256(json.dumps(params, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()[:12]


def smallest_superset(manifests: dict[str, dict], features: list[str], **equal) -> str | None:
    """Name of the manifest with equal parameters whose features hold all asked for: the smallest, then the first by name."""
    fit = [(len(m["features"]), name) for name, m in manifests.items() if set(features) <= set(m["features"]) and all(m.get(k) == v for k, v in equal.items())]
    return min(fit)[1] if fit else None


def collections_over(labels: list[str]) -> list[tuple[str, ...]]:
    """All non-empty subsets of labels, small ones first."""
    return [c for n in range(1, len(labels) + 1) for c in combinations(sorted(labels), n)]
