"""A fence that keeps long expressions in one place of the plan."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fence(df: DataFrame, *names: str) -> DataFrame:
    """Same rows and columns; filters on ``names`` are not pushed below this point.

    Catalyst pushes a filter through a projection by copying the projected expression
    into it.  After a chain of steps that each use the one before several times, such a
    copy grows exponentially with the length of the chain.  A generator that yields
    exactly one row stops the copying without a shuffle or a cache.  Filters on all
    other columns still pass.
    """
    listed = ", ".join(f"`{n}`" for n in names)
    return df.selectExpr(f"* EXCEPT ({listed})", f"inline_outer(array(struct({listed})))")
