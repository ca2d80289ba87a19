"""skyfold — flight sales and seat inventory analytics on Spark.

Star-schema ETL (dimensions, facts, marts), batch flight shopping, reservation
state jobs, data-quality checks and streaming jobs, all written with the
DataFrame / SQL / Structured Streaming APIs.
"""

from skyfold.session import configure, get_spark

__all__ = ["configure", "get_spark"]
