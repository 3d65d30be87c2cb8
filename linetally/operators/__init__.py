"""Relational operators over statement lines."""
