"""Loads, rollups, views and reports composed from the operators."""
