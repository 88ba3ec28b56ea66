"""semjoin: stream-to-catalogue semantic matching on Spark DataFrames.

Every public operator takes and returns DataFrames, so the same code runs in a
batch backfill over a whole archive and inside Structured Streaming's
``foreachBatch``.
"""

__version__ = "0.1.0"
