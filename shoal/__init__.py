"""shoal — schemaless JSON stream ingest on Spark.

Device metrics and events arrive as JSON text with no declared schema.  shoal keeps
the rows that name a device and carry a plausible event time, buckets them by date
and hour, cleans the JSON with native Column expressions and lands it twice: as raw
text partitioned by date/hour, and as flattened, evolving Parquet tables.

Everything on the row path is a Catalyst expression over ``VARIANT`` /
``MAP<STRING,VARIANT>``; there is no Python UDF on the hot path.
"""

from shoal.session import configure, build_session, scratch_root

__all__ = ["configure", "build_session", "scratch_root"]
