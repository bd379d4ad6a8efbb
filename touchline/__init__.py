"""touchline: live and historical match analytics as Spark DataFrame jobs.

Every operator is a plain ``DataFrame -> DataFrame`` function that works on all
matches at once; a single match is a filter.  The same functions serve batch
reads and ``foreachBatch`` callbacks.
"""

__version__ = "0.1.0"
