"""rawhouse: build and query small warehouses from messy raw files on Spark.

Every public operator is a ``DataFrame -> DataFrame`` function built from the
DataFrame / SQL / MLlib API.  Nothing in the core runs a row-at-a-time Python
UDF, and nothing pulls a whole table through the driver.
"""

from rawhouse.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
