"""Joins, roll-ups, geometry, queries and checks."""
