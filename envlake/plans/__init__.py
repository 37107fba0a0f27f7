"""Whole flows over these operators, and the catalogue of queries."""
