"""Inputs built from the given tables, the registered queries over them, and the SQL to compare with."""
