"""docflow — document metadata migration, batching, validation, reconciliation,
reporting and retrieval as Spark DataFrame operators.

Modules: ``docflow.operators`` (report, nesting, joins, batches, upsert,
validate, recon, profile, text, vectors, predict), ``docflow.sources``
(tables, io), ``docflow.functions`` (exprs, udf), ``docflow.streaming``
(streams) and ``docflow.plans`` (the query catalogue used by
``__spark_entry__.py``).
"""

__version__ = "0.1.0"
