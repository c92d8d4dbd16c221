"""Motion of all of silver, or of some hours with the neighbours that lie outside them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from skytracks.functions.times import HourRange
from skytracks.operators.motion import (
    SLICE, asked_motion, asked_spans, marked_inputs, motion_inputs, previous_for, with_motion,
)
from skytracks.schemas import SILVER_HOUR_KEYS
from skytracks.session import cut_lineage


def moving_reports(
    silver: DataFrame,
    features: Sequence[str],
    horizon: int | None = None,
    hours: HourRange | None = None,
    slice_by: str | None = SLICE,
) -> DataFrame:
    """Silver with motion and, given a ``horizon``, targets; with ``hours`` only the reports of these.

    The spans of the aircraft seen in ``hours`` are stored first, a row each, so that Spark knows
    their size when it chooses the join: while they are small, silver is read without a shuffle.
    """
    previous = previous_for(features)
    if hours is None:
        return with_motion(motion_inputs(silver), previous, horizon, slice_by)
    marked = marked_inputs(silver, hours.prunes(SILVER_HOUR_KEYS))
    return asked_motion(marked, cut_lineage(asked_spans(marked)), previous, horizon, slice_by)
