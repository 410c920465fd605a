"""Contract warehouse and table profiling operators for PySpark.

Every operator is a plain function from DataFrames (plus an explicit run date
or run timestamp) to DataFrames.
"""

__version__ = "0.1.0"
