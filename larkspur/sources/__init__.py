"""Readers, line parsers, stores and sinks."""
