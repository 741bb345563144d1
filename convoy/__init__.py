"""convoy: delivery-fleet analytics on Spark DataFrames.

Sub-packages:

* ``functions``  column expressions (parsing, casting, text, flattening)
* ``sources``    file scans and sinks, plus the fixture views derived from testdata
* ``operators``  relational building blocks (interval join, running sums, keyed tables, aggregates)
* ``plans``      the published tables and business queries composed from the operators
* ``streaming``  Structured Streaming ingestion into keyed tables
"""

__version__ = "0.1.0"
