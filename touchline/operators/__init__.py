"""Relational operators, grouped by topic."""
