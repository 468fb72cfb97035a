"""Configuration files and environment substitution."""

from __future__ import annotations

import json
import os
import re
from typing import Any

_VARIABLE = re.compile(r"^\$\{(\w+)\}$")


def substitute(value: Any) -> Any:
    """Replace whole-text ``${NAME}`` by the environment; unknown names stay."""
    if isinstance(value, dict):
        return {k: substitute(v) for k, v in value.items()}
    if isinstance(value, list):
        return [substitute(v) for v in value]
    found = _VARIABLE.match(value) if isinstance(value, str) else None
    return os.environ.get(found.group(1), value) if found else value


def load_config(path: str) -> Any:
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        return substitute(json.loads(text))
    import yaml

    return substitute(yaml.safe_load(text))
