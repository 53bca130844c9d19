"""Layered (bronze / silver / gold) analytics over trip-style tables, on Spark.

Every operator is a function ``f(df, ...) -> DataFrame`` that only extends the
plan.  Jobs run in ``sources.writers`` and ``plans.flows`` alone.
"""
