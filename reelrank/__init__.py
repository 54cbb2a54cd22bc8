"""reelrank: recommendation analytics as PySpark DataFrame jobs.

Every operator is a function ``DataFrame(s) -> DataFrame``; jobs in
``reelrank.plans`` compose them, and the Structured Streaming job in
``reelrank.streaming`` calls the same operators inside ``foreachBatch``.
"""

from reelrank.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
__version__ = "0.1.0"
