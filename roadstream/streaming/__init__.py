"""Structured Streaming versions of the interval, latest and alert reports."""
