"""Whole jobs, and the query catalogue that the checks run."""
