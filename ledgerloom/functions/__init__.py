"""Column builders: money, dates, labels, comparisons and JSON fields."""
