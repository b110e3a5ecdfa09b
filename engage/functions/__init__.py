"""Column expressions; none of them runs Python per row."""

from engage.functions.geo import haversine_miles
from engage.functions.text import token_windows, tokens
from engage.functions.values import basename, first_nonblank, is_blank, nonblank, rounded, to_int

__all__ = [
    "basename",
    "first_nonblank",
    "haversine_miles",
    "is_blank",
    "nonblank",
    "rounded",
    "to_int",
    "token_windows",
    "tokens",
]
