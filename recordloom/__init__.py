"""Multi-source record unification, reporting and drift analytics on PySpark DataFrames."""
