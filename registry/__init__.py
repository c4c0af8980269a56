"""Registered queries over the given tables, each beside the SQL that must agree with it."""
