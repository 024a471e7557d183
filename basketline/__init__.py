"""basketline: composable PySpark operators for retail transaction analytics.

Everything is a plain ``DataFrame -> DataFrame`` function over the session the
caller owns. No module opens a session, hard-codes a path or pulls row data to
the driver.
"""

__version__ = "0.1.0"
