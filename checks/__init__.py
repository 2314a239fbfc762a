"""Registered queries over the given tables, and the independent SQL they are checked against."""
