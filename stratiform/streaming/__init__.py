"""Streaming: incremental landing of newly arrived yearly files.

The reference has no streaming operators (a yearly batch).  Its yearly
refresh -- pick up the new year's file, skip years already loaded -- is
expressed here as an ``availableNow`` Structured Streaming run over the
landing folder (``landing_stream.land_new_files``).
"""

from stratiform.streaming.landing_stream import land_new_files

__all__ = ["land_new_files"]
