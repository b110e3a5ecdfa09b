"""Small value helpers for codes that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonblank(c: Column | str) -> Column:
    """The value, or NULL when it is empty text."""
    return F.nullif(_col(c), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """True for NULL and for text that is empty after trimming."""
    return F.coalesce(F.trim(_col(c)) == "", F.lit(True))


def first_nonblank(*cols: Column | str) -> Column:
    return F.coalesce(*[nonblank(c) for c in cols])


def to_int(c: Column | str) -> Column:
    """Text to integer, NULL when it does not parse.  A JSON number with a fraction arrives as text and is truncated."""
    return F.coalesce(_col(c).try_cast("int"), F.regexp_extract(_col(c), r"^(-?[0-9]+)[.][0-9]+$", 1).try_cast("int"))


def rounded(c: Column | str, digits: int) -> Column:
    """A double rounded as most engines do it: scaled, rounded half away from zero and scaled back.

    Spark rounds the number's shortest decimal text, which differs where that ends in a 5 and the scaled double does not.
    """
    scale = F.lit(10.0**digits)
    return F.round(_col(c).cast("double") * scale, 0) / scale


def basename(path: Column | str) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)
