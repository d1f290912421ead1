"""Readers of index and filing files, and typed table sinks."""
