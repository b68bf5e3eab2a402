"""Readers, the file contract, and result sinks."""
