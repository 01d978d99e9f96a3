"""yardstick: indicator-progress analytics on Spark.

Sparse annual panels (entity x metric x period -> value) from batch refreshes
and a message stream, validated, merged batch-first, scored against targets and
published as fact, dimension and mart tables. See README.md.
"""

__version__ = "0.1.0"
