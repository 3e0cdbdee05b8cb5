"""Small column helpers shared by the operators. Everything stays a built-in expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters use without evaluating them again.

    Catalyst pushes a filter below a projection by repeating the projected expression in it,
    which for a JSON parse or a text fold doubles the work of a row. A filter on the output of
    a generator stays above it, so the columns come out of a one-row ``inline``. It runs
    inside the same codegen stage and shuffles nothing.
    """
    row = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))


def present_only(items: Iterable[Column]) -> Column:
    """Array of the non-NULL items, in order. The items must be distinct.

    ``array_except`` keeps whole-stage codegen; a lambda ``filter`` would end it here.
    """
    return F.array_except(F.array(*items), F.array(F.lit(None)))


# Fixed value: the characters that Python's str.strip removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def python_strip(text: Column) -> Column:
    """Strip all Unicode blanks and U+001C-U+001F; Spark's plain ``trim`` strips spaces only."""
    return F.trim(text, F.lit(BLANKS))


def sanitize_text(value: Column, max_length: int = 1000) -> Column:
    """NULL becomes '', the text is cut to ``max_length`` code points and then stripped."""
    return python_strip(F.substring(F.coalesce(value, F.lit("")), 1, max_length))


def parse_time(text: Column) -> Column:
    return F.try_to_timestamp(text)


def join_group_sizes(
    rows: DataFrame, groups: DataFrame, key: str, size: str, most_hot: int = 100_000
) -> DataFrame:
    """Inner join of rows with their groups, where a group may hold a large part of all rows.

    ``groups`` has one row per key, with the number of its rows in ``size``. Fewer than
    ``most_hot`` groups can hold more than one part in ``most_hot`` of the rows, whatever the
    data, so these are broadcast and their rows are not shuffled at all. The other groups are
    small enough for a shuffled join.
    """
    border = groups.agg(F.ceil(F.sum(size) / most_hot).alias("n")).scalar()
    hot = groups.where(F.col(size) > border)
    cold = groups.where(F.col(size) <= border)
    marked = rows.join(F.broadcast(hot), key, "left")
    in_hot = marked.where(F.col(size).isNotNull())
    in_cold = marked.where(F.col(size).isNull()).select(rows.columns).join(cold, key)
    return in_hot.unionByName(in_cold)
