"""Whole runs: market definitions, the monthly run, and the steps around it."""
