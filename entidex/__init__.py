"""An index of the entity ids found in Parquet feature files, on Spark.

Which ids have features, as of when, and in which file: see README.md.
"""
