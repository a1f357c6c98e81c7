"""Table names that may be placed into a statement."""

from __future__ import annotations

import re

# Fixed value: the names allowed in a statement.
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def checked_name(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a table name: {name!r}")
    return name
