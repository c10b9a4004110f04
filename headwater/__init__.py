"""Headwater: dataset-level lineage and run metadata of data jobs, computed with Spark.

Facts about many applications (job events, plan nodes, RDD graphs, connector
options) come in as tables or streams; resource names, lineage edges and run
records go out as tables.
"""

__version__ = "0.1.0"
