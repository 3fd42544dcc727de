"""Column to Column cleaning rules."""
