"""Queries over the shared test tables, with the SQL each one must agree with."""
