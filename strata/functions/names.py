"""Column names as identifiers."""

from __future__ import annotations


def quoted(name: str) -> str:
    """The name in backticks, so that a dot in it is not read as a field access."""
    return "`" + name.replace("`", "``") + "`"
