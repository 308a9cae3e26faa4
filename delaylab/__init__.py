"""delaylab: flight-delay analytics as Spark DataFrame operators.

Subpackages: ``sources`` (CSV / parquet readers, sinks), ``functions`` (Column -> Column
encodings and holiday rules), ``operators`` (DataFrame -> DataFrame cleaning, windows,
exploration, transforms, sampling), ``ml`` (feature stages, estimators, tuning, evaluation),
``plans`` (named queries over the driver tables, plan inspection), ``streaming`` (the row-wise
feature steps on a file stream).
"""

__version__ = "0.1.0"
