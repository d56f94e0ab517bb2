"""strata: tabular learning workflows expressed as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame`` (or a small fitted
model object that turns into one), chainable with ``df.transform``.
Randomness is always a hash of a seed and a row key, never of partition
layout, so results are reproducible and checkable against plain SQL.
"""

__version__ = "0.1.0"
