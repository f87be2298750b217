"""Incremental runs: new raw files, event streams, and the day partitions they touch."""
