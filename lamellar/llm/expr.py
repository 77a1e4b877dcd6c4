"""Column helpers for native text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The word pattern's complement: the six ASCII white space characters.
WHITE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it.

    Catalyst may copy a projected column into the lambda of a higher-order function, which then computes
    it for every element; a lambda variable can't be copied.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")


def upto(n: Column) -> Column:
    """[0, n) as an array; empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.array().cast("array<int>"))


def window_hashes(hashes: Column, size: int) -> Column:
    """A hash of every ``size`` neighbours of an array of word hashes; empty for shorter ones."""
    return F.transform(upto(F.size(hashes) - (size - 1)), lambda i: F.xxhash64(*(hashes[i + k] for k in range(size))))
