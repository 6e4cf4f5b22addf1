"""Typed scans, published tables, sinks and the date spine."""
