"""letramento — literacy-indicator analytics as Spark DataFrame operators.

Layers: ``functions`` (column expressions), ``operators`` (DataFrame -> DataFrame),
``sources`` (schemas, readers, writers), ``streaming`` (event ingestion) and
``plans`` (bronze / silver / gold jobs and the query catalogue).
"""

__version__ = "0.1.0"
