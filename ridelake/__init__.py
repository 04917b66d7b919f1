"""ridelake: Spark-native trip analytics.

Modules: ``functions`` (column expressions), ``operators`` (cleaning,
keep-latest, quality checks, reports, sinks), ``sources`` (files, test-table
adapter), ``plans`` (the trip models, incremental refresh, pipeline,
registered queries) and ``streaming`` (file-stream ingestion).
"""

__version__ = "0.1.0"
