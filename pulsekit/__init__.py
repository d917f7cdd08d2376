"""pulsekit — post and audience analytics as Spark DataFrame operators.

Every operator is ``fn(df, **params) -> DataFrame``: lazily composed,
no driver-side collection of data, deterministic tie-breaking so the
results can be compared row-for-row against an SQL oracle.
"""

__version__ = "0.1.0"
