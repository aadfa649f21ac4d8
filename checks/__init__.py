"""Queries over the supplied tables, each with an independent SQL statement for comparison."""
