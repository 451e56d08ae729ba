"""Small plan-shaping helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep later filters and projections from copying the expressions of `columns`.

    Catalyst pushes a filter below a projection by substituting its expressions,
    so a filter on a parsed field would parse the text again for every mention.
    A one-element generator is not substituted: what is above it reads its output.
    """
    others = [name for name in df.columns if name not in columns]
    return df.select(*others, F.inline(F.array(F.struct(*columns))))


def join_key(column: str) -> Column:
    """A text key for the small side of a join whose large side may have hot keys.

    The adaptive planner splits a hot partition only if both sides come straight
    from the join's own shuffle. A side that was grouped by the key before is
    already partitioned and would skip that shuffle; a computed key does not.
    """
    return F.concat(F.col(column), F.lit(""))
