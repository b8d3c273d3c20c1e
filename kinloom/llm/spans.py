"""Spans of text as `kind:start:end` in code points, end exclusive."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

Span = tuple[int, int, str]  # start, end, kind

LETTERS_SPACES = "[^ \\t\\n\\v\\f\\r]+"
WORD = re.compile(LETTERS_SPACES)


def joined(spans: Iterable[Span], order: dict[str, int]) -> str:
    """By start, then kind as listed, then end."""
    ranked = sorted(set(spans), key=lambda s: (s[0], order[s[2]], s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ranked)


def digest(spans: Iterable[Span], order: dict[str, int]) -> str:
    return hashlib.sha256(joined(spans, order).encode()).hexdigest()
