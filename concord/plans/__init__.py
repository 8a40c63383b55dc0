"""Whole dataflows, and the catalogue of queries."""
