"""Incremental drivers of the batch jobs (Structured Streaming).

The source marts are batch: a month is loaded when its staging rows are in.
``month_feed`` runs that load from a file stream: every micro-batch of new
staging files names the months it touched, and those month slices of both
payment marts are recomputed and replaced.  No streaming operator beyond
this trigger is needed: there are no event-time windows or state in the
source.
"""

from vitrina.streaming.month_feed import run_month_feed  # noqa: F401
