"""Keep lakehouse tables in step with operational feeds, on Spark DataFrames."""

__version__ = "0.1.0"
