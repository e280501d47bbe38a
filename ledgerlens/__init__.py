"""Project-controls analytics on Spark.

Messy programme exports (cost ledger, change-order log, schedule progress,
contractor pay applications) are cleaned into a star schema and reported on
with earned-value, change-order, cash-flow and variance operators.  Every
operator is a ``DataFrame -> DataFrame`` function over the public DataFrame
API; nothing runs row-at-a-time in Python.
"""

__all__ = ["operators", "sources", "functions", "plans", "streaming"]
