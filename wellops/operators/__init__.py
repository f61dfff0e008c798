"""Operators: functions from DataFrame to DataFrame, usable on their own."""
