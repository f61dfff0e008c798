"""Operators for training-data pipelines: dedup, decontamination, filters, mixing, formatting, tokens."""
