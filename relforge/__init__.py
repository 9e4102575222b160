"""relforge: build, diff, check and publish versioned code-list releases on Spark.

Every operator is a plain function over DataFrames (Catalyst plans the work);
column names default to the RF2 / cluster-management names and can be overridden.
"""

from relforge.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
