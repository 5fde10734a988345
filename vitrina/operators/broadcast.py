"""Broadcast only behind a size check.

The check reads the planner's own size estimate of the (pruned) frame: file
sizes for scans, exact sizes for literal tables.  It starts no job and brings
no rows anywhere.  Beyond the bound the frame is returned unhinted, and the
caller takes a form that needs no broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Estimated bytes.  Compressed columns may unfold to several times their size:
# a roster at the bound stays below some 100 MB in an executor, a bracket sheet
# at its bound holds a few thousand rows.
ROSTER_MAX_BYTES = 16 << 20
BRACKET_MAX_BYTES = 256 << 10
CONTROL_MAX_ROWS = 100_000


def estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits(df: DataFrame, max_bytes: int) -> bool:
    return estimated_bytes(df) <= max_bytes


def checked_broadcast(df: DataFrame, max_bytes: int) -> tuple[DataFrame, bool]:
    """Return ``(frame, hinted)``; the frame carries a broadcast hint iff it fits."""
    if fits(df, max_bytes):
        return F.broadcast(df), True
    return df, False
