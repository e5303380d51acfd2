"""tessera: DataFrame operators for tabular machine-learning data work on Spark.

Every public operator takes DataFrames (and column names) and returns
DataFrames.  Randomness is drawn from hashed row ids, so results do not depend
on partitioning.  Fitted parameters (levels, medians, means) are the only
values brought to the driver, and their size is bounded by the column count.
"""

from tessera.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
