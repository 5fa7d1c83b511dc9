"""quillmart: work-item analytics on Spark.

Versioned source tables in, date-partitioned marts out, plus a set-based,
schema-evolving upsert.  Everything is DataFrame / SQL; nothing is pulled
through the driver.
"""

from quillmart.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
