"""Registries of connectors and scorers, chosen by name or by what is configured."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession


def load(dotted: str):
    """The object at ``package.module:name``."""
    module, _, name = dotted.partition(":")
    return getattr(importlib.import_module(module), name)


def register_connectors(spark: SparkSession, sources: Mapping[str, str]) -> None:
    """Makes data sources given as ``name -> package.module:Class`` readable by their name."""
    for name, dotted in sources.items():
        source = load(dotted)
        if source.name() != name:
            raise ValueError(f"{dotted} calls itself {source.name()}, not {name}")
        spark.dataSource.register(source)


class Scorers:
    """Named scorers in order of preference; each is a factory that gets its settings and gives a callable or None."""

    def __init__(self):
        self._factories: dict[str, Callable[[Mapping[str, str]], Callable | None]] = {}

    def add(self, name: str, factory: Callable[[Mapping[str, str]], Callable | None]) -> None:
        self._factories[name] = factory

    def pick(self, settings: Mapping[str, str], name: str = "") -> Callable | None:
        """The scorer asked for, else the first whose factory finds its settings; None without any."""
        if name:
            if name not in self._factories:
                raise KeyError(name)
            return self._factories[name](settings)
        for factory in self._factories.values():
            scorer = factory(settings)
            if scorer is not None:
                return scorer
        return None
