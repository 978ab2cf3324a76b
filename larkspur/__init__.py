"""Table-level analytics jobs on Spark: text features, classification,
clustering, recommendation, similarity and the evaluation arithmetic around them.

Every operator takes a DataFrame and returns a DataFrame (or a fitted
``pyspark.ml`` model).  See ``README.md`` for the layout.
"""
