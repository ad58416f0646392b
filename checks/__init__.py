"""Queries over the given tables and the SQL they are compared with."""
