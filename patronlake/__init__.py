"""patronlake: customer analytics as Spark DataFrame jobs.

Every operator takes DataFrames and returns a lazy DataFrame. Actions happen only where data is
written (``sources.tables``, ``sources.landing``, ``streaming``), never inside an operator.
"""
