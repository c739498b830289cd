"""pagelake: a Spark-native web-page text pipeline.

Every job takes DataFrames and returns DataFrames. The heavy lifting is
Spark SQL expressions, joins, windows and Spark ML; Python runs only inside
Arrow-batched pandas functions where numpy block arithmetic is needed
(vector search) or where a model slot is plugged in.
"""

__all__ = ["session"]
