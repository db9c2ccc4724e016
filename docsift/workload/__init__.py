"""Queries over the test tables, with the SQL each must agree with."""
