"""Small expression helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# U+0001 is not a legal XML character, so no dump contains it.
MARK = "\x01"

Step = Callable[[Column], Column]


def replace_all(text: Column, cases: Iterable[tuple[str, str]]) -> Column:
    """Chain of ``regexp_replace``; every step refers to its input once."""
    return reduce(lambda c, case: F.regexp_replace(c, *case), cases, text)


def bind(value: Column, body: Step) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def rewrite_matches(text: Column, pattern: str, lead: str, body: Step) -> Column:
    """Replace each match of ``pattern`` by ``body(match)``, in one linear pass.

    All matches must be longer than one character and start with the character
    ``lead``; other tokens are runs without ``lead`` or a single ``lead``.
    """
    char = "\\" + lead
    tokens = F.regexp_extract_all(text, F.lit(f"(?:{pattern})|[^{char}]++|{char}"), F.lit(0))
    return F.array_join(
        F.transform(tokens, lambda x: F.when(x.startswith(lead) & (x != lead), body(x)).otherwise(x)),
        "",
    )


def if_contains(text: Column, needle: str, step: Step) -> Column:
    """Run ``step`` only on texts that contain ``needle``."""
    return F.when(F.contains(text, F.lit(needle)), step(text)).otherwise(text)


def compose(steps: Sequence[Step]) -> Step:
    """One ``Column -> Column`` function out of several, without repeated work."""
    return lambda text: reduce(bind, steps, text)


def apply_steps(df: DataFrame, column: str, steps: Sequence[Step]) -> DataFrame:
    """Apply ``steps`` to ``column`` one after the other.

    Spark merges the steps that use their input once into one projection and
    keeps apart those that use it more often, so nothing is computed twice.
    """
    return reduce(lambda d, step: d.withColumn(column, step(F.col(column))), steps, df)
