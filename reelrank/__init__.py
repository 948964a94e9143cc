"""reelrank: recommendation analytics as Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function built on the public
DataFrame / SQL / MLlib / Structured Streaming APIs.  Nothing is collected to
the driver; thresholds and list sizes are keyword arguments.
"""

from reelrank.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
