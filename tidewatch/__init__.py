"""tidewatch: offshore energy-operations analytics on Spark.

Silver jobs, an operational weather-risk engine, an idempotent star-schema
load, analytical views, serving frames, data-quality checks and a run
ledger, all written as DataFrame -> DataFrame functions on built-in
Spark operators.
"""
