"""millrace: table ingestion, change capture and data quality on the Spark DataFrame API.

Every operator takes DataFrames and returns a DataFrame.  Nothing here holds a
session or global state; business dates are always arguments.
"""

__version__ = "0.1.0"
