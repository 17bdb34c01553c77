"""Incremental runs: only files or rows not seen before."""
