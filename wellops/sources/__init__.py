"""Scans of landing files and of pipeline datasets."""
