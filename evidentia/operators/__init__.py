"""Relational operators on the evidence model."""
