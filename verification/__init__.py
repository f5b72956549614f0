"""Checks of the operators on the given tables: raw feeds, queries and their oracle SQL."""
