"""tidemark: keyed observation series on Spark.

Admits repeated snapshots per key in arrival order, turns them into a gap-free
daily series and derives trailing metrics, in batch and in streams.
"""

from tidemark.schema import SeriesSpec

__all__ = ["SeriesSpec"]
