"""Registered queries over the given test tables and their SQL equivalents."""
