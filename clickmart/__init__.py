"""clickmart: web-shop clickstream marts as Spark DataFrame jobs.

Layers (all functions are DataFrame -> DataFrame, no module state):

* ``sources``   feed schemas, JSON-lines / zip ingest, feeds derived from ``events``
* ``functions`` column expressions shared by the operators
* ``operators`` stage tables, marts, exploration queries and report operators
* ``plans``     the named query registry and the hourly pipeline
* ``streaming`` incremental (availableNow) file ingest
"""

__version__ = "0.1.0"
