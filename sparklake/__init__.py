"""sparklake: lakehouse pipelines and analytic operators as Spark DataFrame functions.

Every public operator takes DataFrames and returns a DataFrame; nothing is
collected to the driver.  Sub-packages:

* ``sources``   – table loaders, adapter views, file sources/sinks, catalog
* ``functions`` – column-expression helpers (casts, dates, JSON, rounding)
* ``operators`` – reusable relational operators (dedup, windows, joins, quality)
* ``plans``     – whole pipelines and the registered query set
* ``streaming`` – Structured Streaming jobs (incremental loads, event upserts)
"""

__version__ = "0.1.0"
