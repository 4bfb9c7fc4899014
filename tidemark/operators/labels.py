"""Names of what to build: a feature with its parameters, collections of them, and a store of collections by tag."""

from __future__ import annotations

import inspect
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tidemark.operators import features as _features  # noqa: F401 (registers the features)
from tidemark.operators import registry
from tidemark.sources import sinks


def default_params(label: str) -> dict:
    """The parameters of a feature with their defaults; an unknown feature is an error."""
    if label not in registry.FEATURES:
        raise ValueError(f"unknown feature {label!r}")
    return {k: v.default for k, v in inspect.signature(registry.FEATURES[label]).parameters.items() if v.default is not v.empty and k != "keep"}


@dataclass(frozen=True)
class FeatureLabel:
    """A feature and its parameters: `label@name:value,name:[a,b]`. Parameters not given have their defaults; unknown ones are an error."""

    label: str
    given: dict = field(default_factory=dict, hash=False)

    def __post_init__(self):
        if unknown := set(self.given) - set(default_params(self.label)):
            raise ValueError(f"{self.label} has no parameters {sorted(unknown)}")

    @property
    def params(self) -> dict:
        return default_params(self.label) | self.given

    def __str__(self) -> str:
        return f"{self.label}@{registry.to_text(self.given)}"

    @classmethod
    def from_str(cls, text: str) -> FeatureLabel:
        label, _, params = text.partition("@")
        return cls(label, {k: tuple(v) if isinstance(v, list) else v for k, v in registry.from_text(params).items()})


@dataclass
class Collection:
    """Features in order; as text they are separated by spaces."""

    labels: list[FeatureLabel] = field(default_factory=list)

    def __iter__(self) -> Iterator[FeatureLabel]:
        return iter(self.labels)

    def __str__(self) -> str:
        return " ".join(map(str, self.labels))

    @classmethod
    def from_str(cls, text: str) -> Collection:
        return cls([FeatureLabel.from_str(x) for x in text.split()])

    def to_dict(self) -> dict:
        return {"features": [{"label": x.label, "params": x.given} for x in self.labels]}

    @classmethod
    def from_dict(cls, found: dict) -> Collection:
        return cls([FeatureLabel(x["label"], {k: tuple(v) if isinstance(v, list) else v for k, v in x["params"].items()}) for x in found["features"]])

    def features(self) -> dict[str, dict]:
        """label: given parameters, as datasets and align.wide take them."""
        return {x.label: x.given for x in self.labels}

    def tag(self) -> str:
        return "__".join(x.label for x in self.labels)

    def subsets(self) -> list[Collection]:
        """All collections of some of the features, small ones first."""
        by_label = {x.label: x for x in self.labels}
        return [Collection([by_label[k] for k in keys]) for keys in registry.collections_over(list(by_label))]


class CollectionStore:
    """Collections as JSON at {root}/feature_labels/{tag}/collection.json, in any store that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.base = spark, f"{root}/feature_labels"

    def _path(self, tag: str) -> str:
        if not tag or "/" in tag:
            raise ValueError(f"not a tag: {tag!r}")
        return f"{self.base}/{tag}/collection.json"

    def save(self, collection: Collection, tag: str) -> None:
        sinks.put_text(self.spark, self._path(tag), json.dumps(collection.to_dict(), indent=1))

    def load(self, tag: str) -> Collection:
        if not self.exists(tag):
            raise FileNotFoundError(f"no collection {tag!r}")
        return Collection.from_dict(json.loads(sinks.get_text(self.spark, self._path(tag))))

    def exists(self, tag: str) -> bool:
        return sinks.exists(self.spark, self._path(tag))

    def tags(self) -> list[str]:
        if not sinks.exists(self.spark, self.base):
            return []
        at, fs = sinks.at(self.spark, self.base)
        return sorted(name for name in (s.getPath().getName() for s in fs.listStatus(at)) if self.exists(name))

    def delete(self, tag: str) -> None:
        if not self.exists(tag):
            raise FileNotFoundError(f"no collection {tag!r}")
        sinks.remove(self.spark, f"{self.base}/{tag}")
