"""Column expressions over post text, all of them built-ins."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Maximal runs of ASCII letters and apostrophes, as written; missing text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[A-Za-z']+"), F.lit(0))


def lower_tokens(text: Column) -> Column:
    """As ``tokens``, in lower case.

    Tokens are cut out first and then lowered: a letter such as the Kelvin sign must not turn
    into a "k" that was not there.
    """
    return F.transform(tokens(text), F.lower)


def distinct_words(text: Column) -> Column:
    return F.array_distinct(lower_tokens(text))


def words_without(text: Column, stops: Iterable[str]) -> Column:
    """Distinct lower-case words of a text that are not in ``stops`` (``array_except`` also
    removes duplicates)."""
    return F.array_except(lower_tokens(text), string_array(stops))


def string_array(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")
