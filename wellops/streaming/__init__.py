"""The raw and validated layers as Structured Streaming jobs."""
