"""Named DataFrame transformations that can be chained."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    func: Step
    version: str = "1.0"
    description: str = ""


class Registry:
    def __init__(self) -> None:
        self._entries: dict[str, Entry] = {}

    def register(self, name: str, func: Step, version: str = "1.0", description: str = "") -> None:
        self._entries[name] = Entry(name, func, version, description)

    def get(self, name: str) -> Step:
        if name not in self._entries:
            raise KeyError(f"transformation '{name}' is not registered")
        return self._entries[name].func

    def compose(self, *names: str) -> Step:
        """One function that applies the named steps in order."""
        steps = [self.get(n) for n in names]
        return lambda df: reduce(lambda d, step: d.transform(step), steps, df)

    def list(self) -> list[dict[str, str]]:
        return [
            {"name": e.name, "version": e.version, "description": e.description}
            for e in self._entries.values()
        ]

    def __len__(self) -> int:
        return len(self._entries)


registry = Registry()
