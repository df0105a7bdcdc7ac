"""tessera: supervised-learning analytics on Spark.

Sub-packages: ``sources`` (tables, delimited/Parquet readers and sinks),
``functions`` (column expressions), ``operators`` (profiling, features,
metrics, prefix sums, history, images, scoring, models), ``streaming``
(Structured Streaming scoring and monitoring), ``plans`` (the registered
queries with their oracle SQL).  ``session`` holds the session settings and
the lineage cut.
"""

__version__ = "0.1.0"
