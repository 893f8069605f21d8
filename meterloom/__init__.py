"""Instruction-corpus preparation, evaluation, serving and cost analytics on Spark.

Every operator takes DataFrames (or columns) and returns DataFrames (or columns).
Nothing here collects rows to the driver.
"""

__version__ = "0.1.0"
