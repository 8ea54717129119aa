"""Operators over batch tables."""
