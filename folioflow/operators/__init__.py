"""Relational operators on the engine's tables."""
