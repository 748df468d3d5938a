"""saasmart: a Spark-native SaaS analytics lakehouse.

Layers: ``sources`` (synthesis, landing files, test-table adapters),
``streaming`` (incremental ingest), ``plans`` (staging, models, catalog,
audit, runner), ``operators`` (skew-safe sessionize),
``functions`` (column expressions).
"""

__version__ = "0.1.0"
