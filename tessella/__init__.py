"""tessella: a PySpark-native engine for course-material knowledge graphs.

Every operator is a function from DataFrames to DataFrames.  The subpackages:

``sources``    readers and writers (tables, texts, exercise JSON, graph scripts)
``functions``  column-level building blocks (text, hashing, coercion)
``operators``  relational, graph and hierarchy operators
``plans``      the registered queries and their SQL oracles
``streaming``  Structured Streaming forms of the ingest operators
"""

__version__ = "0.1.0"
