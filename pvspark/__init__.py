"""Process-variable event analytics on Spark.

Every operator is a function from DataFrames to a DataFrame.  A row of an event
table is one value change of a named signal (a process variable, "PV").
"""

from pvspark.session import build_session, tune

__all__ = ["build_session", "tune"]
