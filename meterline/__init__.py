"""meterline: layered trip-record analytics on Spark.

raw trips (streamed Parquet) -> clean trips -> aggregate tables, plus a
single-pass data-quality profile.  Every operator is a plain
``DataFrame -> DataFrame`` function built on built-in Spark expressions.
"""

from meterline.session import build_session, configure, scratch_path

__all__ = ["build_session", "configure", "scratch_path"]
