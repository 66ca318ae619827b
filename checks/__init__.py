"""Queries over the given tables, one per operator, each with SQL that states its result."""
