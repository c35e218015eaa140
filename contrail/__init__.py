"""Medallion analytics over flight records and aircraft telemetry, on plain Spark.

Layers: files -> bronze -> silver -> gold -> measures.  Every operator takes and
returns DataFrames; only ``sources`` and ``streaming`` touch storage.
"""

from contrail.session import pin_utc, shared_dir, spark_session, stage

__all__ = ["pin_utc", "shared_dir", "spark_session", "stage"]
