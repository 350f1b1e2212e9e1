"""Catalogue, plan, calendar, interaction and control-telemetry analytics on Spark DataFrames."""
