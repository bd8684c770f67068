"""Text similarity for alignment."""

from __future__ import annotations

import difflib
import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from gleanery.functions.text import normal


def sequence_ratio(a: str, b: str) -> float:
    """Gestalt pattern matching; 1 for two empty texts. The order matters, as does the
    library's rule for second texts of 200 characters or more; shorter ones that are equal need no comparison."""
    return 1.0 if a == b and len(b) < 200 else difflib.SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """sequence_ratio of two columns of normal forms; no built-in function computes it."""
    return pd.Series([sequence_ratio(x or "", y or "") for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(StringType())
def unescaped(c: pd.Series) -> pd.Series:
    """All character references of HTML, with or without semicolons."""
    return c.map(lambda x: html.unescape(x) if x else "")


def explanation_similarity(a: Column, b: Column) -> Column:
    """1 if equal in normal form, 0.98 if one holds the other, else their ratio."""
    x, y = normal(a), normal(b)
    held = (x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x))
    # A function in Python is called for all rows: those settled without it give it nothing to compare.
    rest = lambda t: F.when((x == y) | held, F.lit("")).otherwise(t)
    return F.when(x == y, F.lit(1.0)).when(held, F.lit(0.98)).otherwise(ratio(rest(x), rest(y)))


def option_share(text: Column, options: Column) -> Column:
    """Share of the options (array of strings) whose normal form the text has; 0 without options."""
    found = F.filter(options, lambda v: (v != "") & F.contains(normal(text), normal(v)))
    return F.size(found) / F.greatest(F.size(options), F.lit(1))
