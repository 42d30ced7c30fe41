"""dispatchboard: event-stream analytics for call logs and transit boards on PySpark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's own
expressions, so the same call serves a static table and a streaming one.
"""

__version__ = "0.1.0"
