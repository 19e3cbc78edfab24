"""Sensor-telemetry analytics on Spark DataFrames.

Nothing in this package runs Python inside a task: every operator is an expression over the
DataFrame, SQL or Structured Streaming API, so a plan stays inside Catalyst and codegen.
"""
