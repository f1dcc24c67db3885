"""Column names that no input uses."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, lengthened until no column is called so (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
