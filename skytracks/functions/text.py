"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode counts as white space, which SQL trim (U+0020 only) does not cover.
WHITE_SPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def clean_callsign(callsign: Column) -> Column:
    """Strip white space at both ends; a missing callsign becomes the empty string."""
    return F.btrim(F.coalesce(callsign, F.lit("")), F.lit(WHITE_SPACE))
