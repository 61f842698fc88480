"""equiframe: equity-factor analytics on Spark.

Packages: ``functions`` (scalar Column expressions), ``operators``
(column sets, filters, blocked windows, joins, keys, reshape), ``sources``
(scans, payload and vendor normalisers, upserts), ``plans`` (the domain
functions and the refresh actions), ``streaming`` (incremental daily load).
"""

__version__ = "0.1.0"
