"""Column functions: keys, dates, comparisons, JSON extraction."""
