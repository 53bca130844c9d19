"""Column-name rules.  These work on names (metadata), never on data."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

# The patterns that define a word break in a column name.
SEPARATOR_RUN = re.compile(r"[\s-]+")
INNER_CAPITAL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def snake_case(name: str) -> str:
    """``RatecodeID`` -> ``ratecode_id``; a run of capitals stays one word."""
    return INNER_CAPITAL.sub("_", SEPARATOR_RUN.sub("_", name)).lower()


def snake_case_all(names: Sequence[str]) -> list[str]:
    """Snake-case every name; refuse when two of them end up the same."""
    renamed = [snake_case(name) for name in names]
    clashes = {new for new, times in Counter(renamed).items() if times > 1}
    if clashes:
        sources = [old for old, new in zip(names, renamed) if new in clashes]
        raise ValueError(f"columns {sources} share a snake-case name: {sorted(clashes)}")
    return renamed
