"""Operators: functions from DataFrame to DataFrame, or ML pipelines."""
