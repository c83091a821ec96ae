"""tidemark: subscription-business marts as Spark DataFrame jobs.

Layers: landed JSON pages -> bronze Parquet -> keyed raw tables -> incremental
staging -> gold star schema (dimensions, facts, aggregates).
"""

__version__ = "0.1.0"
