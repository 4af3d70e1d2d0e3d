"""Small helpers for writing expressions as SQL text.

Tables with hundreds of generated columns are built with SQL text: parsing one expression is much
cheaper than assembling it from many ``Column`` calls, and the plan is the same.
"""

from __future__ import annotations


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(value: float) -> str:
    """A double literal that reads back to exactly the same number."""
    return f"{float(value)!r}D" if value == value and abs(value) != float("inf") else f"double('{value}')"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def over(order: str, partition_by=(), frame: str = "") -> str:
    parts = [f"PARTITION BY {', '.join(quoted(name) for name in partition_by)}"] if partition_by else []
    parts.append(f"ORDER BY {quoted(order)} ASC NULLS LAST")
    return f"OVER ({' '.join(parts)} {frame})"
