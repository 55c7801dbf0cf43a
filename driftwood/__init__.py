"""driftwood: data-pipeline operators on open-source PySpark.

Every operator is a function from DataFrames to a DataFrame (or a job that
writes a table and returns a report DataFrame). Heavy work is always a Spark
plan; the driver only sees schemas, paths and counts.
"""

__version__ = "0.1.0"
