"""Queries over the supplied tables that exercise each operator, with their SQL."""
