"""Click-through-rate data work on PySpark DataFrames.

Profile categorical impressions, encode them into wide and deep features, split and batch
them, train and score a wide-and-deep classifier with Spark jobs, and evaluate the scores.
"""
