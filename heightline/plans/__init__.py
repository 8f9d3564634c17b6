"""Queries over the test tables, each next to the SQL it is checked against."""
