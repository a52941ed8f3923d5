"""Columns that several text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: A word is a run of code points other than space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text; splitting at single spaces needs no regular expression."""
    spaced = F.regexp_replace(text, r"[\x09-\x0D]", " ")
    return F.array_remove(F.split(spaced, " "), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that columns of the caller cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])
