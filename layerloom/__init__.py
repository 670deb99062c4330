"""Layered batch analytics on Spark: ingest, validate, version, model, report.

Every operator takes and returns DataFrames built from Spark's own
expressions. Nothing here registers a UDF or moves table rows to the driver.
"""
