"""Column names that an input doesn't have."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], base: str) -> str:
    """``base``, with underscores added until no column has the name in any case."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base
