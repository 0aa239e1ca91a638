"""Scans, sinks and the transactions table derived from the test tables."""
