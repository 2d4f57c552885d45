"""Named extension points, configuration and remembered calls."""

from __future__ import annotations

import dataclasses
import json
import os
from collections import OrderedDict
from collections.abc import Callable, Iterator
from typing import Generic, TypeVar

T = TypeVar("T")


class Registry(Generic[T]):
    """Things of one kind by name; a name is taken once unless it is replaced on purpose."""

    def __init__(self, kind: str):
        self.kind, self._found = kind, {}

    def register(self, name: str, replace: bool = False) -> Callable[[T], T]:
        def put(thing: T) -> T:
            if name in self._found and not replace:
                raise ValueError(f"{self.kind} {name} is taken")
            self._found[name] = thing
            return thing

        return put

    def __getitem__(self, name: str) -> T:
        if name not in self._found:
            raise KeyError(f"unknown {self.kind} {name}; known: {', '.join(sorted(self._found))}")
        return self._found[name]

    def __contains__(self, name: str) -> bool:
        return name in self._found

    def __iter__(self) -> Iterator[str]:
        return iter(sorted(self._found))


#: Extension points beyond meshes, tiles and commands: (left, right) to matches; matches to matches; candidates to
#: ranked ones; pixels to pixels; image to features; a task's rows to results.
MATCHERS: Registry = Registry("matcher")
MATCH_FILTERS: Registry = Registry("match filter")
SELECTION_STRATEGIES: Registry = Registry("selection strategy")
IMAGE_CONVERTERS: Registry = Registry("image converter")
DETECTORS: Registry = Registry("detector")
OPERATIONS: Registry = Registry("operation")
MISSIONS: Registry = Registry("mission")


def load_config(kind: type[T], path: str | None = None, prefix: str = "OROGEN_", environment: dict[str, str] | None = None) -> T:
    """A dataclass from its defaults, then a JSON file, then variables PREFIX + FIELD in capitals; unknown fields are refused."""
    fields = {f.name: f for f in dataclasses.fields(kind)}
    values: dict[str, object] = {}
    if path:
        with open(path, encoding="utf-8") as file:
            values |= json.load(file)
    unknown = sorted(set(values) - set(fields))
    if unknown:
        raise ValueError(f"unknown settings {unknown}")
    environment = dict(os.environ) if environment is None else environment
    for name, field in fields.items():
        text = environment.get(prefix + name.upper())
        if text is not None:
            default = getattr(kind(), name) if field.default is not dataclasses.MISSING or field.default_factory is not dataclasses.MISSING else None
            values[name] = text if isinstance(default, str) else json.loads(text.lower() if isinstance(default, bool) else text)
    return kind(**values)


class Remembered(Generic[T]):
    """A function's results by argument, the least recently used forgotten beyond ``capacity``."""

    def __init__(self, function: Callable[..., T], capacity: int = 100):
        self.function, self.capacity, self._known = function, capacity, OrderedDict()

    def __call__(self, *key) -> T:
        if key in self._known:
            self._known.move_to_end(key)
        else:
            self._known[key] = self.function(*key)
            if len(self._known) > self.capacity:
                self._known.popitem(last=False)
        return self._known[key]
