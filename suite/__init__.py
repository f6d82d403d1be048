"""Queries over the test tables, one per operator, each with the SQL it is checked against."""
