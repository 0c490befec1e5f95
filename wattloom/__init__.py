"""Monthly time-series panel analytics on Spark DataFrames.

A *panel* is a DataFrame with one row per (series keys, month).  The number of
rows of one series is bounded by the calendar, so windows partitioned by the
series keys never meet an unbounded group; anything that can be unbounded
(raw rows per month, entities per parent, whole tables) is aggregated with
map-side combine instead.
"""

from wattloom.model import Family

__all__ = ["Family"]
