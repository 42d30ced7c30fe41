"""Readers: topic streams and logs, JSON/CSV lookup files, incremental pulls."""
