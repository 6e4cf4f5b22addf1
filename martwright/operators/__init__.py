"""Metrics, checks, contracts, freshness, profiling and catalog health."""
