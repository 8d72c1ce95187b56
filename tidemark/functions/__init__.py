"""Column expressions: tokens, numbers, markers and formatting."""

from tidemark.functions.tokens import (
    CLEAR,
    counted,
    guard_forbidden,
    parse_long,
    parse_marked,
    split_tokens,
)

__all__ = [
    "CLEAR",
    "counted",
    "guard_forbidden",
    "parse_long",
    "parse_marked",
    "split_tokens",
]
