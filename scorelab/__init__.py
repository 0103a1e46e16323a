"""scorelab: credit-risk tabular analytics and model evaluation on Spark.

Every public operator takes DataFrames and returns DataFrames. Nothing
row-level is collected to the driver; the only driver-side values are
parameters whose size is fixed by the caller (bin counts, grids, the number
of runs), never by the data.
"""

__version__ = "0.1.0"
