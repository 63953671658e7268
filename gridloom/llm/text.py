"""Expressions on text that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_count(text: Column | str) -> Column:
    """Number of words; 0 for null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column | str) -> Column:
    """Lower-cases A-Z only, so offsets and other scripts stay as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names based on ``names`` that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
