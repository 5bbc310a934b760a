"""Operators of a training-data pipeline, each a Spark job over whole tables.

Nothing else in the package imports this subpackage; the driver entry adds its
queries only when it is present.
"""
