"""keelson: change-data-capture to star-schema analytics on Spark.

Layers (all DataFrame -> DataFrame, I/O only at the edges):

* ``sources``   table / JDBC / change-stream readers, generated calendar
* ``functions`` column expressions (decimal decode, epoch, hashing, rules)
* ``operators`` CDC parse + current state, quality split, dimensions,
                facts, rollups, data-quality reports
* ``streaming`` Structured Streaming ingest, dedupe, windows, late rows
* ``sinks``     overwrite / partition overwrite / idempotent batch writers
* ``plans``     the named queries over the test tables and the pipeline
"""

__version__ = "0.1.0"
