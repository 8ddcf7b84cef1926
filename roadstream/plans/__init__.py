"""Operators put together: the whole feature table, and the registered queries."""
