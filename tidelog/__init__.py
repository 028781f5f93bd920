"""tidelog: Spark-native operators for partitioned, offset-addressed event logs.

Every batch operator is a ``DataFrame -> DataFrame`` function; the live half
runs on Structured Streaming. Sub-packages:

* ``functions``  column expressions (UUID / enum checks, offsets, backoff, ...)
                 and the strict JSON-variant decoder
* ``sources``    log batches, registry / subscription / cursor tables, and the
                 derivation of those tables from the shared test data
* ``operators``  envelope decode / encode, publish, consume, catalog, stats
* ``plans``      composed jobs: the flagship consumer report and the publish
                 retry rounds
* ``streaming``  foreachBatch consumers with commit policies, stateful batch
                 flushing, streaming compaction and traffic
"""

__version__ = "0.1.0"
