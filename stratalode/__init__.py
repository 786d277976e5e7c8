"""Batch medallion analytics on PySpark: bronze JSON, cleaned silver, gold indicators.

Every operator is a plain ``DataFrame -> DataFrame`` function, so jobs are
written as ``df.transform(op).transform(op2, arg)``. The caller owns the
SparkSession; nothing here runs at import time.
"""
