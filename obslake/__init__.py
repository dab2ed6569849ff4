"""obslake: trusted daily observations and exposure-aware reliability metrics on Spark.

Every operator is a DataFrame-to-DataFrame function built from Spark SQL expressions,
so Catalyst sees the whole plan: predicates reach the Parquet scan, unused columns are
pruned and aggregations are split into a map-side partial and a shuffled final step.
"""

__version__ = "0.1.0"
