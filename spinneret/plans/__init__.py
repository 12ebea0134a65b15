"""Whole jobs, and the catalog of queries on the test tables."""
