"""Bronze, silver and gold table operators for PySpark.

Every operator takes and returns DataFrames and leaves planning to Spark.
"""
