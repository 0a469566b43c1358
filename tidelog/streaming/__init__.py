"""Sinks and running of streams."""
