"""Fitted recipes and cleaning rules on streams."""
