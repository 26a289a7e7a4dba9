"""sessionmetrics: clickstream session, ranking and funnel analytics on Spark.

Pure ``DataFrame -> DataFrame`` functions; no global session.  See
``operators`` for the metric tables, ``sources`` for readers and sinks,
``plans`` for the batch job and query catalogue, ``streaming`` for the
incremental ingest of new event files.
"""

__version__ = "0.1.0"
