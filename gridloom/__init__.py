"""Gridded population data on Spark: crosswalks, roll-ups, queries and data checks as DataFrame jobs."""
