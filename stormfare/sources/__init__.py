"""Readers, file checks and layouts of the raw feeds."""
