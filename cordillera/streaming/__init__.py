"""Incremental work: what may be skipped, what has expired, and file streams that stop when done."""
