"""lexiflow — text-to-text corpus preparation and evaluation on Spark DataFrames.

Every public operator takes and returns a ``pyspark.sql.DataFrame``; nothing is
collected to the driver.  Sub-packages:

* ``sources``   — readers and writers (aligned text files, record tables, stand-in fixtures)
* ``functions`` — Column-level helpers (whitespace, tokenisers, n-grams, score arrays, LCS)
* ``operators`` — DataFrame -> DataFrame operators (prep, batching, losses, overlap, runs, infer)
* ``plans``     — composed jobs and the query catalogue used by ``__spark_entry__``
* ``streaming`` — Structured Streaming form of the metric log and running best checkpoint
"""

__version__ = "0.1.0"
