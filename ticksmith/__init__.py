"""ticksmith — market-tick analytics as plain Spark DataFrame functions.

Layers (each a DataFrame -> DataFrame function, usable in batch and, where
Spark allows it, in Structured Streaming):

* ``sources``   — table readers, Kafka/file tick sources, driver-data views
* ``operators`` — ingest (normalise / publish / parse), bars, staging,
                  marts, quality checks, reports
* ``functions`` — column expressions (rounding, NaN-safe predicates,
                  zone-free time arithmetic, report formatting)
* ``plans``     — composed batch jobs, storage layout, retention, the query
                  catalogue used by ``__spark_entry__``
* ``streaming`` — bronze and bar streaming queries with checkpoints
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming", "schemas"]
