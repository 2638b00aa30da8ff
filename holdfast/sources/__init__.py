"""Readers for sales, dimension, result and feedback tables."""
