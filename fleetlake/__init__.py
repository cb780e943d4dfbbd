"""fleetlake: a Spark-native lakehouse for run-to-failure sensor readings.

Every operator is a ``DataFrame -> DataFrame`` function, over built-in Spark
expressions where they say what is to be computed; writes live in :mod:`fleetlake.sinks` and
:mod:`fleetlake.operators.ledger` only.
"""

from fleetlake.settings import Series, Settings, SkewLimits

__all__ = ["Series", "Settings", "SkewLimits"]
