"""Event analytics as PySpark DataFrame functions.

Every operator takes DataFrames and returns a DataFrame. The windowed and enrichment operators take a
batch table or a stream; where Spark needs a different plan for the two, the operator picks it by
``df.isStreaming``.
"""
