"""Table and column names."""

from __future__ import annotations

import re

LAYERS = ("bronze", "silver", "gold")
_SNAKE = re.compile(r"[a-z][a-z0-9]*(_[a-z0-9]+)*")


def snake_case(name: str) -> str:
    """``CustomerID``, ``customer-id`` and ``Customer Id`` all become ``customer_id``."""
    spaced = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name.strip())
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", spaced)
    cleaned = re.sub(r"[^A-Za-z0-9]+", "_", spaced).strip("_").lower()
    if not cleaned:
        raise ValueError(f"no usable characters in column name {name!r}")
    return cleaned if cleaned[0].isalpha() else f"c_{cleaned}"


def is_snake_case(name: str) -> bool:
    return _SNAKE.fullmatch(name) is not None


def check_table_name(name: str, layer: str) -> None:
    """Refuse names that are not snake case or lack their layer's prefix."""
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}, not {layer!r}")
    if not is_snake_case(name) or not name.startswith(f"{layer}_"):
        raise ValueError(f"{name!r} must be snake case and start with '{layer}_'")
