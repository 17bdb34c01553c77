"""Readers: files and tables to ``documents(path, ext, text, error)``."""
