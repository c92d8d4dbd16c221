"""Row-offset lookups (lag / lead) per key that no single key can turn into one huge task.

A plain window sends all rows of a key to one task. Here each key's history is cut into
slices that follow its order (days, for reports), and the lookup runs per slice. Only rows
near a slice edge can need a row of another slice, so only those few rows per slice meet
again in a window over the whole key. The result equals the plain window row for row; the
largest task holds one slice, or the edge rows of one key (a fixed number per slice).

Both branches read the same shuffle: their sub-plans are identical up to it, so Spark reuses it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_NEAR_EDGE, _NO_PREVIOUS, _NO_AHEAD = "_near_edge", "_no_previous", "_no_ahead"


def with_neighbours(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    slices: Sequence[Column],
    previous: Mapping[str, str] | None = None,
    ahead: Mapping[str, str] | None = None,
    steps: int = 1,
) -> DataFrame:
    """Add columns read from the row before and from the row ``steps`` rows later, per key.

    ``previous`` and ``ahead`` map new column names to source columns. Rows are ordered by
    ``order`` (nulls first), then by all other columns so that equal times have a fixed order.
    ``slices`` must be functions of the ``order`` columns that never go back and forth along
    that order: all rows of one slice are consecutive within their key. Without slices it is
    the plain window, for keys known to be short.
    """
    previous, ahead = dict(previous or {}), dict(ahead or {})
    if steps < 1:
        raise ValueError("steps must be at least 1")
    reach = steps if ahead else 1
    total = [*order, *(c for c in df.columns if c != key and c not in order)]
    names = [f"_slice_{i}" for i in range(len(slices))]
    in_slice = Window.partitionBy(key, *names).orderBy(*total)
    in_key = Window.partitionBy(key).orderBy(*total)

    def before(column: Column, rows: int, window) -> Column:
        return F.lag(column, rows).over(window)

    def after(column: Column, rows: int, window) -> Column:
        return F.lead(column, rows).over(window)

    if not slices:
        return df.select(
            "*",
            *(before(F.col(source), 1, in_key).alias(name) for name, source in previous.items()),
            *(after(F.col(source), steps, in_key).alias(name) for name, source in ahead.items()),
        )
    here = F.lit(True)
    sliced = df.select("*", *(c.alias(n) for c, n in zip(slices, names, strict=True))).select(
        "*",
        *(before(F.col(source), 1, in_slice).alias(name) for name, source in previous.items()),
        *(after(F.col(source), steps, in_slice).alias(name) for name, source in ahead.items()),
        (before(here, reach, in_slice).isNull() | after(here, reach, in_slice).isNull()).alias(_NEAR_EDGE),
        (before(here, 1, in_slice).isNull() if previous else ~here).alias(_NO_PREVIOUS),
        (after(here, steps, in_slice).isNull() if ahead else ~here).alias(_NO_AHEAD),
    )
    unresolved = F.col(_NO_PREVIOUS) | F.col(_NO_AHEAD)
    inside = sliced.filter(~unresolved)
    # A row may miss one lookup only; what its own slice has resolved stays as it is.
    across = sliced.filter(_NEAR_EDGE).select(
        *df.columns,
        *(
            F.when(F.col(_NO_PREVIOUS), before(F.col(source), 1, in_key)).otherwise(F.col(name)).alias(name)
            for name, source in previous.items()
        ),
        *(
            F.when(F.col(_NO_AHEAD), after(F.col(source), steps, in_key)).otherwise(F.col(name)).alias(name)
            for name, source in ahead.items()
        ),
        unresolved.alias("_unresolved"),
    )
    out = [*df.columns, *previous, *ahead]
    return inside.select(*out).unionByName(across.filter("_unresolved").select(*out))
