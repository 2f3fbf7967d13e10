"""Queries over the test tables and the SQL each of them is compared with."""
