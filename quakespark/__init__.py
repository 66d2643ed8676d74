"""quakespark: double-difference earthquake-catalog analytics on PySpark DataFrames."""
