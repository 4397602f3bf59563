"""ontime: Spark-native flight-delay analytics.

Readers and layer writers (``ontime.sources``), column expressions
(``ontime.functions``), cleaning / profiling / rates / sampling / ML
operators (``ontime.operators``), the reference's stages and the registered
queries (``ontime.plans``) and incremental ingest (``ontime.streaming``).
"""

__version__ = "0.1.0"
