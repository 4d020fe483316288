"""Readers, sinks and persistence."""
