"""paddock — session analytics for motor-racing data on Spark.

Raw per-session files (bronze) are conformed and cleaned into keyed silver
tables, then aggregated into ranked gold tables.  Every operator is a pure
``DataFrame -> DataFrame`` function; actions only happen in sinks.
"""

__all__ = ["schemas", "session"]
