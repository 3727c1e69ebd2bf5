"""Relational operators of the recommender (joins, aggregates, windows)."""
