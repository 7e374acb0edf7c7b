"""Reading, writing and freezing tables."""
