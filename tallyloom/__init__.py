"""tallyloom: a Spark-first engine for molecular-count tables.

Sub-packages: ``operators`` (relational and per-group operators), ``sources`` (file formats),
``functions`` (column expressions), ``plans`` (named queries and their SQL twins),
``streaming`` (Structured Streaming variants).
"""

__version__ = "0.1.0"
