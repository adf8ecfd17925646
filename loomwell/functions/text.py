"""String columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_name(c: Column) -> Column:
    """Trim, turn ``_`` and ``-`` into spaces, capitalise each word."""
    return F.initcap(F.translate(F.trim(c), "_-", "  "))


def words(c: Column) -> Column:
    """Lower-case words cut at white space; edge blanks give empty strings."""
    return F.split(F.lower(c), r"\s+")


def word_rows(c: Column, name: str = "word") -> Column:
    return F.explode(words(c)).alias(name)
