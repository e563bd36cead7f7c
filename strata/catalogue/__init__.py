"""Queries over the given tables, each with an independent SQL form to compare with."""
