"""Helpers for expressions over arrays that stay in DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[ \t-\r]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value bound to a name, so that the optimizer does not put it in for each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words between ASCII white space; one empty string for a text without words."""
    return F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE)), WHITE_RUN)
